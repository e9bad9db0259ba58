"""Diff of a table against an older copy by digests, without reading what is equal.

A copy is dealt into buckets by key hash, one folder each, and keeps a digest for each
bucket beside it: the number of rows, and the sums and exclusive ors of two row hashes. They do
not depend on the order of rows and can be merged, so digests of groups of buckets
are made from those of buckets. A diff makes the same digests of the source in one
pass (added up before anything is shuffled), descends from groups of buckets to the
buckets that differ, and reads only those of the copy.

Equal digests are taken for equal content: the two hashes have 64 bits each. A bucket of a copy in
which a key repeats is always read, so that a source which repeats it too is found out.
Rows with a null key have a bucket of their own, which is always read, as they match nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablevault.functions.columns import any_null, hashable, payload_bytes
from tablevault.operators.sync import sync_diff, unique_keys

BUCKET = "_tv_bucket"
NULL_BUCKET = -1
BUCKETS = 1024
FAN_OUT = 32  # buckets under one group
NULL_TASKS = 64  # that write the rows with a null key
SUMS = [f"{part}_{k}" for k in (1, 2) for part in ("low", "high", "mix")]


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.when(any_null(keys), F.lit(NULL_BUCKET)).otherwise(
        F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets))).cast("int")


def digests(df: DataFrame, keys: Sequence[str], compare_cols: Sequence[str], buckets: int) -> DataFrame:
    """``(bucket, n, sums)`` of a table: one partial aggregate, no row is shuffled."""
    names = [*keys, *compare_cols]
    cols = [hashable(F.col(c), df.schema[c].dataType) for c in names]
    # a null leaves a hash as it is, so which columns are null is hashed too
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    rows = df.select(bucket_of(keys, buckets).alias("bucket"), *[F.xxhash64(F.lit(k), *cols, nulls).alias(f"h{k}") for k in (1, 2)])
    aggs = [F.count("*").alias("n")]
    for k in (1, 2):
        h = F.col(f"h{k}")
        aggs += [F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias(f"low_{k}"), F.sum(F.shiftright(h, 32)).alias(f"high_{k}"),
                 F.bit_xor(h).alias(f"mix_{k}")]
    return rows.groupBy("bucket").agg(*aggs)


def _groups(level: DataFrame) -> DataFrame:
    """Digests of groups of ``FAN_OUT`` buckets from those of the buckets."""
    group = F.floor(F.col("bucket") / FAN_OUT).cast("int")
    aggs = [F.bit_xor(c).alias(c) if c.startswith("mix") else F.sum(c).alias(c) for c in SUMS]
    return level.groupBy(group.alias("bucket")).agg(F.sum("n").alias("n"), *aggs)


def _differ(a: DataFrame, b: DataFrame) -> DataFrame:
    """Buckets of two digest tables that are not equal, or are in one only."""
    both = a.unionByName(b).groupBy("bucket", "n", *SUMS).agg(F.count("*").alias("times"))
    return both.where("times = 1").select("bucket").distinct()


def differing_buckets(a: DataFrame, b: DataFrame, buckets: int) -> list[int]:
    """Buckets whose digests differ, found from the top down: at each level only the members
    of groups that differ are compared. At most ``buckets + 1`` numbers reach the driver."""
    levels = [(a, b)]
    size = buckets
    while size > FAN_OUT:
        levels.append(tuple(_groups(x) for x in levels[-1]))
        size = -(-size // FAN_OUT)
    found = _differ(*levels.pop())
    for x, y in reversed(levels):
        below = found.withColumnRenamed("bucket", "group")
        inside = F.floor(F.col("bucket") / FAN_OUT) == F.col("group")
        found = _differ(*(side.join(below, inside, "left_semi") for side in (x, y)))
    return sorted(r[0] for r in found.collect())


def digested_copy(df: DataFrame, path: str, keys: Sequence[str], compare_cols: Sequence[str], buckets: int = BUCKETS,
                  codec: str = "zstd", repeats: bool = False) -> None:
    """Write ``df`` as a copy with digests to a new folder ``path``. Non-null keys must be unique
    unless they may repeat (``repeats``)."""
    spark, keys = df.sparkSession, list(keys)
    named = df if repeats else unique_keys(df.where(~any_null(keys)), keys).unionByName(df.where(any_null(keys)))
    spread = F.pmod(F.xxhash64(*[hashable(F.col(f.name), f.dataType) for f in df.schema]), F.lit(NULL_TASKS))
    dealt = named.withColumn(BUCKET, bucket_of(keys, buckets)).repartition(
        F.col(BUCKET), F.when(F.col(BUCKET) == NULL_BUCKET, spread).otherwise(0))
    dealt.write.option("compression", codec).partitionBy(BUCKET).parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    marks = digests(rows, keys, compare_cols, buckets).withColumn("repeats", F.lit(False))
    if repeats:
        often = rows.where(~any_null(keys)).groupBy(*keys).count().where("count > 1")
        often = often.select(bucket_of(keys, buckets).alias("bucket"), F.lit(True).alias("often")).distinct()
        marks = marks.join(often, "bucket", "left").withColumn("repeats", F.col("often").isNotNull()).drop("often")
    marks.withColumns({"buckets": F.lit(buckets), "columns": F.lit("\n".join([*keys, "", *compare_cols]))}).coalesce(1).write.parquet(
        f"{path.rstrip('/')}/_digests")


def _marks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/_digests")


def buckets_with_repeats(spark: SparkSession, path: str) -> list[int]:
    """Buckets of a copy in which a non-null key stands more than once."""
    marks = _marks(spark, path)
    if "repeats" not in marks.columns:  # a copy from before keys could repeat
        return []
    return [r[0] for r in marks.where("repeats").select("bucket").collect()]


def read_digests(spark: SparkSession, path: str, keys: Sequence[str], compare_cols: Sequence[str]) -> tuple[DataFrame, int | None]:
    """The digests beside a copy and the number of its buckets, None if the copy has no rows."""
    rows = _marks(spark, path)
    first = rows.first()
    if first and first["columns"] != "\n".join([*keys, "", *compare_cols]):
        raise ValueError(f"the digests of {path} are of other columns")
    return rows.select("bucket", "n", *SUMS), first["buckets"] if first else None


def sync_diff_digest(src: DataFrame, path: str, keys: Sequence[str], compare_cols: Sequence[str],
                     payload_cols: Sequence[str] | None = None) -> DataFrame:
    """``sync_diff`` of ``src`` against the copy at ``path``; buckets of the copy that equal the
    source's are not read. Keys that repeat in the source fail the job, as there; those that the
    copy was allowed to repeat are compared row by row."""
    spark, keys, compare_cols = src.sparkSession, list(keys), list(compare_cols)
    marks, buckets = read_digests(spark, path, keys, compare_cols)
    if buckets is None:
        empty = spark.createDataFrame([], src.schema)
        return sync_diff(src, empty, keys, compare_cols, payload_cols)
    mine = digests(src, keys, compare_cols, buckets)
    again = buckets_with_repeats(spark, path)
    differ = sorted({*differing_buckets(mine, marks, buckets), *again, NULL_BUCKET})
    here = bucket_of(keys, buckets)
    tgt = spark.read.parquet(path).where(F.col(BUCKET).isin(differ)).drop(BUCKET)
    open_ = sync_diff(src.where(here.isin(differ)), tgt, keys, compare_cols, payload_cols, target_repeats=bool(again))
    # equal digests: every key here has its equal there
    out = [F.col(k) for k in keys] + [F.lit("unchanged").alias("cls")]
    if payload_cols is not None:
        out.append(payload_bytes(payload_cols).alias("bytes"))
    return open_.unionByName(src.where(~here.isin(differ)).select(*out))
