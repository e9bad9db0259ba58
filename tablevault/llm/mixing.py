"""Mixing sources to target weights as a curriculum that changes over training.

Each source has a weight and a schedule: a piecewise linear curve over training
time 0 to 1. The weight fixes the words a source gives in all (its target); the
schedule spreads them over time. Its integral is the share of the target asked
for up to a time; inverting it gives the time at which a word is needed.

A source's documents are ordered by a hash of their id, pass after pass, up to
``max_passes`` passes. A document's middle word lies at some offset in that
order; the copy is taken if the offset is within the target, at the training
time of that offset. The running sum is built from sums per (source, hash
bucket), so a source that holds most documents is worked on by many tasks.

Sources are one row each, as their weights are given one by one. A null text has
no words; documents without words are taken as often as their place is within
the target, giving no words. Null source is a source, the last one. Repeated rows
are documents of their own. Extra columns are ignored or carried along; an empty
table gives no rows. Reruns agree: the order depends on ids only.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablevault.functions.columns import content_of
from tablevault.llm.common import WORD_PATTERN, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_PASSES = 2
# (time, weight) knots, dealt to sources in turn like the weights
SCHEDULES = (((0.0, 1.5), (0.6, 1.0), (1.0, 0.5)),
             ((0.0, 1.0), (1.0, 1.0)),
             ((0.0, 0.5), (0.4, 1.0), (1.0, 1.5)))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, share: float = SHARE, max_passes: int = MAX_PASSES) -> DataFrame:
    """``sizes`` (``source``, ``source_size``, ``weight``) with ``target``.

    Targets are ``level * weight``, at most ``max_passes`` times the size. In the
    order of cap over weight, sources are capped until the level that the rest
    of the words gives to the rest of the weights is below the next cap."""
    every = W.partitionBy(F.lit(0))
    order = W.partitionBy(F.lit(0)).orderBy("_ratio", F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(0, W.unboundedFollowing)
    df = sizes.withColumn("_cap", F.col("source_size") * max_passes).withColumn("_ratio", F.col("_cap") / F.col("weight"))
    df = df.withColumn("_level", (F.sum("source_size").over(every) * F.lit(share)
                                  - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / F.sum("weight").over(after))
    level = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "_level"))).over(every)["_level"]
    df = df.withColumn("_final", level)
    cap = F.col("_cap").cast("double")
    return df.withColumn("target", F.when(F.col("_final").isNull(), cap).otherwise(
        F.least(cap, F.col("_final") * F.col("weight")))).drop("_cap", "_ratio", "_level", "_final")


def time_of(share: Column, schedule: tuple[tuple[float, float], ...]) -> Column:
    """The training time at which a share of a source's words has been asked for."""
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:])]
    total, done, found = sum(areas), 0.0, F.lit(schedule[-1][0])
    for k in reversed(range(len(areas))):
        (t0, w0), (t1, w1) = schedule[k], schedule[k + 1]
        done = sum(areas[:k])
        need = F.greatest(share * total - done, F.lit(0.0))  # area inside this piece
        slope = (w1 - w0) / (t1 - t0)
        inside = need / w0 if slope == 0 else (F.sqrt(F.greatest(need * 2 * slope + w0 * w0, F.lit(0.0))) - w0) / slope
        found = F.when(share * total <= done + areas[k], inside + t0).otherwise(found)
    return F.least(found, F.lit(schedule[-1][0]))


def placed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_passes: int = MAX_PASSES,
           schedules: tuple = SCHEDULES, mark: Column | None = None) -> DataFrame:
    """One row per document: ``id_col``, ``size``, ``source_size``, ``target``,
    ``taken`` and ``positions``, the training times of its copies. ``mark``: an
    expression over ``docs`` to carry along."""
    rows = written(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("hash"),
        (F.lit(None).cast("string") if mark is None else mark).alias("mark")), "sizes")
    rows = rows.withColumn("bucket", F.substring("hash", 1, 3))
    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    totals = buckets.groupBy("source").agg(F.sum("words").alias("source_size"))
    rank = (F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1).cast("int")
    sources = totals.withColumn("rank", rank).withColumn(
        "weight", F.get(F.array(*map(F.lit, weights)), F.col("rank") % len(weights)))
    sources = targets(sources, share, max_passes).withColumnRenamed("source", "of")
    ahead = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = buckets.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0))).drop("words")
    starts = written(starts.join(sources, F.col("source").eqNullSafe(F.col("of"))).select(
        F.col("source").alias("of"), F.col("bucket").alias("in"), "ahead", "source_size", "target", "rank"), "starts")
    within = W.partitionBy("source", "bucket").orderBy("hash", "id", "size").rowsBetween(W.unboundedPreceding, -1)
    df = rows.withColumn("_before", F.coalesce(F.sum("size").over(within), F.lit(0))).join(
        starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("in")))
    middle = F.col("ahead") + F.col("_before") + F.col("size") / 2
    copies = []
    for k in range(max_passes):
        offset = middle + F.col("source_size") * k
        part = offset / F.greatest("target", F.lit(1e-9))
        time = time_of(part, schedules[0])
        for c in range(1, len(schedules)):
            time = F.when(F.col("rank") % len(schedules) == c, time_of(part, schedules[c])).otherwise(time)
        copies.append(F.when(offset <= F.col("target"), time))
    df = df.withColumn("positions", F.array_compact(F.array(*copies)))
    return df.select(F.col("id").alias(id_col), "size", "source_size", "target",
                     (F.size("positions") * F.col("size")).cast("long").alias("taken"), "positions", "mark")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The documents in training order, each as often as it is taken, columns as
    they were; the files of the result are consecutive ranges of training time."""
    mark = F.to_json(F.struct(F.col(id_col).alias("a"), F.col(source_col).alias("b"),
                              F.xxhash64(*content_of(docs)).alias("c"), F.length(text_col).alias("d")))
    times = placed(docs, id_col, text_col, source_col, mark=mark, **options).select(
        F.explode("positions").alias("_tv_time"), F.col("mark").alias("_tv_mark"))
    once = docs.withColumn("_tv_of", mark).dropDuplicates(["_tv_of"])  # equal rows are told apart by their times alone
    return (once.join(times, F.col("_tv_of") == F.col("_tv_mark")).repartitionByRange("_tv_time", id_col)
            .sortWithinPartitions("_tv_time", id_col).drop("_tv_of", "_tv_mark", "_tv_time"))


def written_order(docs: DataFrame) -> tuple[Column, ...]:
    """Expressions that order rows read from Parquet as ``mixed`` wrote them: by the
    number in the file's name, then the row in the file. Rows that come from no
    files are ordered as they come."""
    try:
        where = docs.metadataColumn("_metadata")
        docs.select(where["row_index"])
    except AnalysisException:
        return (F.monotonically_increasing_id(),)
    number = F.regexp_extract(where["file_name"], r"^part-(\d+)", 1).try_cast("long")
    return number, where["file_path"], where["row_index"]
