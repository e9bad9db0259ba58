"""Helpers shared by the operators of this subpackage.

Text reaches the Arrow operators as flat UTF-8 buffers, so that words and
windows of a whole batch are found with a few array operations.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablevault.session import new_work_dir

# Words are runs of anything but the six ASCII blanks.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
BLANK_PATTERN = r"[\x20\x09-\x0D]+"

# Bytes of a batch that a task receives, and of one slice that is worked on at once.
BATCH_BYTES = 8 << 20
SLICE_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

MIX1, MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * MIX1
    x ^= x >> np.uint64(33)
    x *= MIX2
    x ^= x >> np.uint64(33)
    return x


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of at most ``limit`` text bytes, a longer
    text alone."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < batch.num_rows:
        base = size[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(size, base + limit, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows in one array, and the offsets of the rows; null
    counts as empty."""
    col = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    offsets = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of true bytes; runs end with their row."""
    n = len(inside)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    first = np.empty(n, bool)
    first[0] = inside[0]
    np.logical_and(inside[1:], ~inside[:-1], out=first[1:])
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[edges] = inside[edges]
    starts = np.flatnonzero(first)
    last = np.empty(n, bool)
    last[-1] = inside[-1]
    np.logical_and(inside[:-1], ~inside[1:], out=last[:-1])
    last[edges[1:] - 1] = inside[edges[1:] - 1]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
    inverse = pow(base, -1, 1 << 64)
    up, down = np.empty(1 << bits, np.uint64), np.empty(1 << bits, np.uint64)
    up[0] = down[0] = 1
    have = 1
    while have < 1 << bits:  # doubling: powers[have:2*have] = powers[:have] * base**have
        up[have:2 * have] = up[:have] * np.uint64(pow(base, have, 1 << 64))
        down[have:2 * have] = down[:have] * np.uint64(pow(inverse, have, 1 << 64))
        have *= 2
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return up, down, table


LONG_SPAN = 1 << 10  # bytes of spans that are hashed one by one


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes wherever they stand.

    Eight bytes after eight are mixed into the state, all spans at once; every step is a
    bijection of the state for given bytes, so spans of up to eight bytes and one length
    never collide. Longer ones collide like random numbers, whatever their pattern;
    callers that cannot live with one in 2**64 compare the bytes."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from every place on
    size = ends - starts
    out = mix(size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD6E8FEB86659FD93))
    live, at = np.flatnonzero((size > 0) & (size <= LONG_SPAN)), 0
    while len(live):
        left = size[live] - at
        x = eight[starts[live] + at]
        short = left < 8
        x[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        out[live] = mix(out[live] ^ x) + np.uint64(0xA0761D6478BD642F)
        live, at = live[left > 8], at + 8
    for k in np.flatnonzero(size > LONG_SPAN):
        digest = hashlib.blake2b(data[starts[k]:ends[k]].tobytes(), digest_size=8).digest()
        out[k] = np.frombuffer(digest, np.uint64)[0]
    return mix(out)


def spans_equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes at ``a`` are those at ``b``, pair by pair."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    out = np.ones(len(a), bool)
    live, at = np.flatnonzero((a != b) & (size > 0) & (size <= LONG_SPAN)), 0
    while len(live):
        differ = eight[a[live] + at] ^ eight[b[live] + at]
        left = size[live] - at
        short = left < 8
        differ[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        out[live[differ != 0]] = False
        live, at = live[(differ == 0) & (left > 8)], at + 8
    for k in np.flatnonzero((a != b) & (size > LONG_SPAN)):
        out[k] = np.array_equal(data[a[k]:a[k] + size[k]], data[b[k]:b[k] + size[k]])
    return out


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: it is computed
    once, its lineage ends there, and lost executors cost no earlier work."""
    spark = df.sparkSession
    path = f"{new_work_dir(spark, label)}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of an action when the action ends."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def words_of(text: Column) -> Column:
    """Words of a text as an array, empty for null."""
    return F.when(text.isNull() | ~text.rlike(WORD_PATTERN), F.array().cast("array<string>")).otherwise(
        F.split(F.regexp_replace(text, rf"^{BLANK_PATTERN}|{BLANK_PATTERN}$", ""), BLANK_PATTERN))


def file_system(path: str):
    """pyarrow's file system for a URI or plain path, and the path in it."""
    from pyarrow import fs

    if not re.match(r"\w+:", path):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def ship_code(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per context: a job
    then needs no copy of it installed on the cluster."""
    import os
    import tempfile
    import zipfile

    import tablevault

    sc = spark.sparkContext
    if getattr(sc, "_tablevault_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(tablevault.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="tablevault-code-"), "tablevault_code.zip")  # read by the driver only
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("tablevault", os.path.relpath(full, home)))
    sc.addPyFile(path)
    sc._tablevault_shipped = True


def map_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors, in batches of
    bounded size, so that long texts do not pile up in a task."""
    spark = df.sparkSession
    ship_code(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(function, schema)
