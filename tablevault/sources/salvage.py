"""Copies of damaged Parquet files that lose the damaged row groups only (O3).

A tolerant read gives up the rest of a split from its first unreadable page on, and
a split may hold many row groups. Here the files are read as usual first. Those
that gave fewer rows than their footers promise, and only those, are read again in
splits so small that each holds the middle of at most one row group (Spark reads a
row group where its middle lies), and rows that were not copied yet are added. Page
checksums are verified, so a damaged page that still decodes does not pass as data.

The driver sees one line for each row group of a damaged file, never rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tablevault.session import session_conf
from tablevault.sources import fs
from tablevault.sources.snapshot import (
    SOURCE_FILE,
    SOURCE_ROW,
    file_losses,
    next_version,
    plain_file,
    tolerant_reader,
    version_path,
)

CHECKSUMS = "parquet.page.verify-checksum.enabled"
NO_MARKER = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
TASK_BYTES = 8 << 20  # of damaged files, read by one task
GROUPS = "path string, row_group int, first_row long, rows long, start long, bytes long"


def row_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple]:
    """``GROUPS`` rows of some files, off their footers; files without a readable one give none."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    # calls into the JVM take most of the time: classes are looked up once, a footer comes as one text
    open_, file_of, path_of = (jvm.org.apache.parquet.hadoop.ParquetFileReader.open,
                               jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath, jvm.org.apache.hadoop.fs.Path)
    as_json = jvm.org.apache.parquet.hadoop.metadata.ParquetMetadata.toJSON

    def read(path: str) -> list[tuple]:
        try:
            reader = open_(file_of(path_of(path), conf))
        except Exception:  # the footer cannot be read: the whole file is lost, and reported so
            return []
        try:
            blocks = json.loads(as_json(reader.getFooter()))["blocks"]
        finally:
            reader.close()
        out, first = [], 0
        for k, block in enumerate(blocks):
            out.append((path, k, first, block["rowCount"], block["startingPos"], block["compressedSize"]))
            first += block["rowCount"]
        return out

    return [g for groups in fs.at_once(read, paths) for g in groups]


def split_sizes(groups: Sequence[tuple]) -> dict[str, int]:
    """For each file a split size, a power of two, below the distance of any two neighbouring
    middles of its row groups."""
    middles: dict[str, list[float]] = {}
    for path, _k, _first, _rows, start, size in groups:
        middles.setdefault(path, []).append(start + size / 2)
    out = {}
    for path, at in middles.items():
        least = min((b - a for a, b in zip(at, at[1:])), default=float(1 << 27))
        out[path] = 1 << (max(1, int(least)).bit_length() - 1)
    return out


def literal_path(path: str) -> str:
    """A path in which no character stands for others."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _placed(rows: DataFrame, drop_cols: Sequence[str]) -> DataFrame:
    return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c not in drop_cols],
                       plain_file(F.col("_metadata.file_path")).alias(SOURCE_FILE),
                       F.col("_metadata.row_index").alias(SOURCE_ROW))


def _of_files(spark: SparkSession, placed: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Copied rows that come from some files."""
    names = spark.createDataFrame([(p,) for p in paths], StructType([StructField(SOURCE_FILE, StringType())]))
    return placed.join(F.broadcast(names), SOURCE_FILE, "left_semi")


def _lost_groups(spark: SparkSession, groups: Sequence[tuple], placed: DataFrame, unreadable: Sequence[tuple]) -> DataFrame:
    """Row groups that were not copied whole, and files that cannot be read at all (null group)."""
    table = spark.createDataFrame(list(groups), GROUPS).drop("start", "bytes")
    starts = table.groupBy("path").agg(F.sort_array(F.collect_list("first_row")).alias("starts"))
    rows = placed.join(F.broadcast(starts), placed[SOURCE_FILE] == starts["path"])
    at = F.size(F.filter("starts", lambda s: s <= F.col(SOURCE_ROW))) - 1
    copied = rows.groupBy("path", at.alias("row_group")).agg(F.count("*").alias("copied"))
    both = table.join(copied, ["path", "row_group"], "left").withColumn("copied", F.coalesce("copied", F.lit(0)))
    lost = both.where("copied < rows").select("path", "row_group", "first_row", "rows", "copied",
                                              (F.col("rows") - F.col("copied")).alias("lost"))
    return lost.unionByName(spark.createDataFrame([(path, None, None, None, copied, None) for path, copied in unreadable], lost.schema))


def snapshot_salvage(spark: SparkSession, path: str, target: str, schema: StructType | None = None, codec: str = "zstd",
                     drop_cols: Sequence[str] = (), recursive: bool = False) -> tuple[int, DataFrame]:
    """Copy all that can be read below ``path``, a folder or a file, to a new snapshot version of ``target``; returns
    ``(version, losses)``.

    ``losses`` has one row for each row group that was not copied whole: ``path``,
    ``row_group`` and ``first_row`` (both from 0), ``rows`` by the footer, ``copied`` and
    ``lost``; a file without a readable footer is one row with null group and loss. The version
    appears to readers when both reads are done. An empty source, a file without rows
    and a source without damage give no losses.
    """
    options = {CHECKSUMS: "true"}
    reader = tolerant_reader(spark, path, schema, "parquet", recursive, options)
    if fs.is_dir(spark, path):  # folders of partitions keep their meaning when single files are read
        options["basePath"] = path
    version = next_version(spark, target)
    dest = version_path(target, version)

    def append(rows: DataFrame) -> None:
        rows.write.mode("append").option("compression", codec).option(NO_MARKER, "false").parquet(dest)

    append(_placed(reader, drop_cols))
    marks = StructType([StructField(SOURCE_FILE, StringType()), StructField(SOURCE_ROW, LongType())])
    copied = spark.read.schema(marks).parquet(dest)
    losses = file_losses(spark, path, reader, copied.groupBy(F.col(SOURCE_FILE).alias("path")).agg(
        F.count("*").alias("copied")), recursive).where("rows is null or lost > 0")
    found = losses.select("path", "length", "rows", "copied").collect()  # one line for each damaged file
    whole = {r["path"]: r["length"] for r in found}
    groups = row_groups(spark, [r["path"] for r in found if r["rows"] is not None])
    sizes = split_sizes(groups)
    for size in sorted(set(sizes.values())):
        paths = [p for p, s in sizes.items() if s == size]
        have = _of_files(spark, copied, paths)
        # many splits, and many files to list, to a task: small ones do not become tasks of their own
        few = 4 * spark.sparkContext.defaultParallelism
        tasks = max(few, sum(whole[p] for p in paths) // TASK_BYTES)
        with session_conf(spark, spark__sql__files__maxPartitionBytes=str(size), spark__sql__files__openCostInBytes=str(size),
                          spark__sql__files__maxPartitionNum=str(tasks),
                          spark__sql__sources__parallelPartitionDiscovery__parallelism=str(few)):
            fine = tolerant_reader(spark, [literal_path(p) for p in paths], reader.schema, "parquet", False, options)
            fine = _placed(fine, drop_cols).join(have, [SOURCE_FILE, SOURCE_ROW], "left_anti")
            append(fine.select(*[c for c in reader.columns if c not in drop_cols], SOURCE_FILE, SOURCE_ROW))
    fs.write_text(spark, f"{dest}/_SUCCESS", "")
    again = _of_files(spark, spark.read.schema(marks).parquet(dest), list(sizes))
    unreadable = [(r["path"], r["copied"]) for r in found if r["rows"] is None]
    report = f"{target.rstrip('/')}/_reports/v={version}"
    out = _lost_groups(spark, groups, again, unreadable)
    out.write.parquet(report)
    return version, spark.read.schema(out.schema).parquet(report)
