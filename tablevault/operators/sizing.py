"""Sizing and block arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tablevault.functions import constants as K
from tablevault.functions.columns import byte_length, payload_bytes


def volume_gib(kib: str) -> Column:
    """``(kib * 2) div 1048576 + 2``: the two truncating divisions by 1024 as one."""
    return F.expr(f"({kib} * {K.SIZE_FACTOR}) div {K.KIB_PER_GIB} + {K.SIZE_HEADROOM_GIB}")


def plan_size(df: DataFrame, by: Sequence[str], payload_cols: Sequence[str]) -> DataFrame:
    """Volume size per group: at least twice the payload, in whole GiB, plus 2.

    ``kib`` rounds the byte count up to whole KiB; ``gib`` is
    ``volume_gib(kib)``. An empty group still gets 2 GiB. Plain partial
    aggregation: a hot group is pre-summed on every map task before the
    shuffle.
    """
    g = df.groupBy(*by).agg(F.coalesce(F.sum(payload_bytes(payload_cols)), F.lit(0))
                            .cast("long").alias("bytes"))
    return (g.withColumn("kib", F.expr("(bytes + 1023) div 1024"))
            .withColumn("gib", volume_gib("kib")))


def _plain_path(path: Column) -> Column:
    """A path without its scheme and authority, so that ``file:/x``,
    ``file:///x`` and ``/x`` compare equal; no character of it is a pattern."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?(?=/)", "")


def plan_size_files(files: DataFrame, root: str, depth: int = 1) -> DataFrame:
    """``du -s`` over a file listing: bytes per folder ``depth`` levels below
    ``root``, then the same KiB / GiB rule as ``plan_size``.

    ``files`` is a ``binaryFile`` listing (``path``, ``length``); its contents
    are never read. Files directly under ``root`` count under ``'.'``.
    """
    path = _plain_path(F.col("path"))
    prefix = F.concat(F.regexp_replace(_plain_path(F.lit(root)), "/+$", ""), F.lit("/"))
    rel = F.when(path.startswith(prefix), F.substring(path, F.length(prefix) + 1, F.length(path))).otherwise(path)
    parts = F.split(rel, "/")
    folder = F.when(F.size(parts) > depth,
                    F.array_join(F.slice(parts, 1, depth), "/")).otherwise(F.lit("."))
    g = files.groupBy(folder.alias("folder")).agg(F.sum("length").cast("long").alias("bytes"))
    return (g.withColumn("kib", F.expr("(bytes + 1023) div 1024"))
            .withColumn("gib", volume_gib("kib")))


def _as_binary(df: DataFrame, payload: str):
    if isinstance(df.schema[payload].dataType, BinaryType):
        return F.col(payload)
    return F.encode(F.col(payload), "UTF-8")


def block_counts(nbytes: str, size: int = K.BLOCK_SIZE) -> list[Column]:
    """``full_blocks``, ``partial_blocks`` (0 or 1) and ``padded_bytes`` for a
    byte count column; the last short block is padded to ``size``."""
    full = F.expr(f"{nbytes} div {size}")
    partial = F.when(F.col(nbytes) % size > 0, 1).otherwise(0)
    return [full.alias("full_blocks"), partial.alias("partial_blocks"),
            ((full + partial) * size).cast("long").alias("padded_bytes")]


def block_layout(df: DataFrame, id_cols: Sequence[str], payload: str,
                 size: int = K.BLOCK_SIZE) -> DataFrame:
    """Full blocks, the trailing partial block and the padded size of each payload."""
    return (df.select(*id_cols, byte_length(payload).alias("bytes"))
            .select(*id_cols, "bytes", *block_counts("bytes", size)))


def block_split(df: DataFrame, id_cols: Sequence[str], payload: str,
                size: int = K.BLOCK_SIZE) -> DataFrame:
    """One row per fixed-size block, numbered from 0, the last padded with NUL.

    Works on bytes, not characters. An empty or null payload gives no rows.
    The block number is generated per row and the block cut from the
    payload inside the same code-generated stage, so a payload is never
    copied once per block.
    """
    b = _as_binary(df, payload)
    nbytes = F.octet_length(F.col(payload))  # UTF-8 bytes of a string: no second encode
    blocks = (df.where(nbytes > 0)
              .select(*id_cols, b.alias("_tv_bin"), nbytes.alias("_tv_n")))
    blocks = blocks.select(
        *id_cols, "_tv_bin",
        F.explode(F.sequence(F.lit(0), F.expr(f"cast((_tv_n + {size - 1}) div {size} - 1 as int)")))
        .alias("block_no"))
    piece = F.col("_tv_bin").substr(F.col("block_no") * size + 1, F.lit(size))
    return blocks.select(*id_cols, "block_no",
                         F.rpad(piece, size, F.lit(bytes([0]))).alias("block"))


def parse_transfer(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Adds ``bytes`` and ``seconds`` parsed from a transfer summary line."""
    line = F.col(line_col)
    return (lines
            .withColumn("bytes", F.regexp_extract(line, K.TRANSFER_BYTES, 1).try_cast("long"))
            .withColumn("seconds", F.regexp_extract(line, K.TRANSFER_SECONDS, 1).try_cast("double")))


def parse_records(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """Adds ``full_records``, ``partial_records`` and ``direction`` from
    ``N+M records in|out`` lines."""
    line = F.col(line_col)
    return (lines
            .withColumn("full_records", F.regexp_extract(line, K.RECORDS, 1).try_cast("long"))
            .withColumn("partial_records", F.regexp_extract(line, K.RECORDS, 2).try_cast("int"))
            .withColumn("direction", F.nullif(F.regexp_extract(line, K.RECORDS, 3), F.lit(""))))


def transfer_rate(lines: DataFrame, by: Sequence[str], line_col: str = "line") -> DataFrame:
    """Bytes, seconds and MB/s per group; the rate is total bytes over total
    seconds (not a mean of rates) and is null when no time was spent."""
    parsed = parse_transfer(lines, line_col).where(F.col("bytes").isNotNull())
    g = parsed.groupBy(*by).agg(F.sum("bytes").cast("long").alias("bytes"),
                                F.sum("seconds").alias("seconds"))
    return g.withColumn("mb_per_s",
                        F.try_divide(F.col("bytes") / F.lit(K.BYTES_PER_MB), F.col("seconds")))
