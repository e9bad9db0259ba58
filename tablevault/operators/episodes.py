"""Waiting again and again: every stay outside a state until it is reached.

A key may leave the target state and come back. An episode begins with a key's first report or
with the first report after one in the target state that is not in it, and ends with the next
report of the target state; further reports of that state belong to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablevault.functions import constants as K
from tablevault.operators.lifecycle import wait_columns


def wait_episodes(ev: DataFrame, key: str, ts: str, state: str, target: str, order: str, slice_s: int = 86_400,
                  poll_s: int = K.POLL_INTERVAL_S) -> DataFrame:
    """``(key, episode, started, reached_at, reports, wait figures)``; episodes count from 1.

    Reports are taken by time, equal times by ``order``, which must tell them apart. A key's reports
    are split into slices of ``slice_s`` seconds, so that a key with a third of all reports
    does not end in one task: a slice only needs the state that the slice before ended in
    and the number of episodes begun so far, which are carried over the slices' one-row
    summaries. Reports without a key or time are left out; a null state is not the target.
    """
    there = F.coalesce(F.col(state) == F.lit(target), F.lit(False))
    at = F.struct(F.col("_ts"), F.col("_ord"))
    rows = ev.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key).alias("_key"), F.col(ts).alias("_ts"), F.col(order).alias("_ord"), there.alias("_there"),
        F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / slice_s).alias("_slice"))
    slices = Window.partitionBy("_key").orderBy("_slice")
    ends = rows.groupBy("_key", "_slice").agg(F.max_by("_there", at).alias("_last"))
    before = ends.select("_key", "_slice", F.lag("_last").over(slices).alias("_before"))
    inside = Window.partitionBy("_key", "_slice").orderBy("_ts", "_ord")
    rows = rows.join(before, ["_key", "_slice"])
    prior = F.coalesce(F.lag("_there").over(inside), "_before")
    # a report begins an episode if it is a key's first, or leaves the target state
    rows = rows.withColumn("_new", (prior.isNull() | (prior & ~F.col("_there"))).cast("long"))
    rows = rows.withColumn("_nth", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    begun = rows.groupBy("_key", "_slice").agg(F.sum("_new").alias("_begun"))
    carried = begun.select("_key", "_slice", F.coalesce(F.sum("_begun").over(
        slices.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_carried"))
    g = rows.join(carried, ["_key", "_slice"]).groupBy(
        "_key", (F.col("_carried") + F.col("_nth")).alias("episode")).agg(
        F.min("_ts").alias("started"), F.min(F.when(F.col("_there"), F.col("_ts"))).alias("reached_at"),
        F.count("*").alias("reports"))
    return g.select(F.col("_key").alias(key), "episode", "started", "reached_at", "reports",
                    *wait_columns(F.col("started"), F.col("reached_at"), poll_s))
