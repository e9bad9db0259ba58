"""Small Hadoop FileSystem helpers (listing and marker files).

They go through the cluster's Hadoop configuration, so they work the same on
local disk, HDFS or an object store. Only directory metadata passes through
the driver, never table data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


CALLS_AT_ONCE = 16


def at_once(what: Callable, items: Sequence) -> list:
    """``what`` of every item, several at a time: calls that wait for a file system."""
    with ThreadPoolExecutor(CALLS_AT_ONCE) as pool:
        return list(pool.map(what, items))


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p)) and bool(fs.getFileStatus(p).isDirectory())


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` (empty if it does not exist)."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Full paths of the data files directly below ``path``."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isFile() and not name.startswith(("_", ".")):
            out.append(st.getPath().toString())
    return out


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder and everything below it (no error if it is gone)."""
    fs, p = _fs_and_path(spark, path)
    fs.delete(p, True)


def overwrite_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Replace a file's content (used to build a damaged-file fixture)."""
    fs, p = _fs_and_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def overwrite_parts(spark: SparkSession, parts: Sequence[tuple[str, int, int]], byte: int) -> None:
    """Set ``size`` bytes from ``start`` of each file ``(path, start, size)`` to one value (used to build
    a damaged-file fixture). What stays of a file does not leave the JVM."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path_of, buffer, copy = jvm.org.apache.hadoop.fs.Path, jvm.java.io.ByteArrayOutputStream, jvm.org.apache.commons.io.IOUtils.copyLarge

    def set_(part: tuple[str, int, int]) -> None:
        path, start, size = part
        p = path_of(path)
        fs, kept = p.getFileSystem(conf), buffer()
        stream = fs.open(p)
        try:
            copy(stream, kept, 0, start)
            kept.write(bytearray([byte]) * size)
            stream.seek(start + size)
            copy(stream, kept)
        finally:
            stream.close()
        out = fs.create(p, True)
        try:
            kept.writeTo(out)
        finally:
            out.close()

    at_once(set_, parts)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that must not exist yet."""
    fs, p = _fs_and_path(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """Content of a small file."""
    fs, p = _fs_and_path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small text file, None if it does not exist."""
    return read_bytes(spark, path).decode() if exists(spark, path) else None


def numbers(spark: SparkSession, base: str) -> list[int]:
    """All ``v=N`` below ``base``, committed or not, ascending: one listing."""
    return sorted(int(n[2:]) for n in list_dirs(spark, base) if n.startswith("v=") and n[2:].isdigit())


def newest_committed(spark: SparkSession, base: str, upto: int | None = None):
    """Committed versions up to ``upto``, newest first. Each is looked at only when
    asked for, so finding the newest costs one listing and usually one probe."""
    for v in reversed(numbers(spark, base)):
        if (upto is None or v <= upto) and exists(spark, f"{base.rstrip('/')}/v={v}/_SUCCESS"):
            yield v


def versions(spark: SparkSession, base: str, committed_only: bool = True) -> list[int]:
    """Versions ``v=N`` below ``base``, ascending. With ``committed_only`` a
    ``_SUCCESS`` marker must prove the write committed."""
    found = []
    for name in list_dirs(spark, base):
        if name.startswith("v=") and name[2:].isdigit():
            if not committed_only or exists(spark, f"{base.rstrip('/')}/{name}/_SUCCESS"):
                found.append(int(name[2:]))
    return sorted(found)
