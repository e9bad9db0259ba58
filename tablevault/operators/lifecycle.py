"""Listings over time, waiting, run outcome and cleanup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablevault.functions import constants as K
from tablevault.functions.columns import hashable


def latest_entry(df: DataFrame, by: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The newest row per group: greatest ``order_cols``, ties broken by the
    remaining columns so the answer is stable.

    Done as ``max(struct(...))`` per group, an aggregate with a map-side
    partial step: a group holding a third of all rows is reduced on every map
    task and never gathered into one task, which a ``row_number`` window
    would do.
    """
    by, order_cols = list(by), list(order_cols)
    rest = [c for c in df.columns if c not in by and c not in order_cols]
    row = F.struct(*[F.col(c) for c in order_cols + rest])
    # maps have no order: rows with them are told apart by their text
    place = F.struct(*[F.col(c) for c in order_cols], *[hashable(F.col(c), df.schema[c].dataType) for c in rest])
    top = (F.max_by(row, place) if "map<" in df.schema.simpleString() else F.max(row)).alias("_tv_top")
    g = df.groupBy(*by).agg(top)
    fields = {c: F.col("_tv_top")[c].alias(c) for c in order_cols + rest}
    return g.select(*[F.col(c) if c in by else fields[c] for c in df.columns])


def new_entries(after: DataFrame, before: DataFrame) -> DataFrame:
    """Distinct rows of the later listing that the earlier one lacks
    (``EXCEPT DISTINCT``; nulls compare equal).

    Both listings are tagged, unioned and grouped once on all columns: a
    single shuffle, hash-aggregated with a map-side partial step, so a row
    repeated many times collapses before it is shuffled. (An anti join would
    shuffle each side on its own, and the optimizer would move it below the
    left side's distinct, so repeated rows would travel raw.)
    """
    cols = after.columns
    tagged = (after.select(*cols, F.lit(1).alias("_tv_in_after"), F.lit(0).alias("_tv_in_before"))
              .unionByName(before.select(*cols, F.lit(0).alias("_tv_in_after"),
                                         F.lit(1).alias("_tv_in_before"))))
    g = tagged.groupBy(*cols).agg(F.max("_tv_in_after").alias("_tv_a"),
                                  F.max("_tv_in_before").alias("_tv_b"))
    return g.where((F.col("_tv_a") == 1) & (F.col("_tv_b") == 0)).select(*cols)


def _micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def wait_columns(started: Column, reached_at: Column, poll_s: int = K.POLL_INTERVAL_S) -> list[Column]:
    """Wait figures from the first-seen time and the first time the target
    state was seen.

    The poller checks once, then loops: check, sleep ``poll_s``, count. With
    ``T`` the seconds until the target state, the loop turns
    ``ceil(T / poll_s) + 1`` times (0 when ``T <= 0``), sleeps ``poll_s`` per
    turn, and reports ``poll_s * (turns + 1)`` because its counter starts at 1.
    Never reaching the state gives nulls and ``reached = false``.
    """
    step = poll_s * 1_000_000
    us = _micros_between(started, reached_at)
    polls = (F.when(reached_at.isNull(), F.lit(None))
             .when(us <= 0, F.lit(0))
             .otherwise(F.floor((us + F.lit(step - 1)) / F.lit(step)) + 1)).cast("long")
    return [
        (us / F.lit(1_000_000.0)).alias("wait_s"),
        polls.alias("polls"),
        (polls * poll_s).cast("long").alias("slept_s"),
        ((polls + 1) * poll_s).cast("long").alias("reported_s"),
        reached_at.isNotNull().alias("reached"),
    ]


def wait_profile(ev: DataFrame, key: str, ts: str, state: str, target: str,
                 poll_s: int = K.POLL_INTERVAL_S) -> DataFrame:
    """Time, polls and sleep until each key first reaches ``target``.

    Two ``min`` aggregates per key (partial on every map task), then
    arithmetic; the time is measured from the key's first event.
    """
    g = ev.groupBy(key).agg(
        F.min(ts).alias("started"),
        F.min(F.when(F.col(state) == F.lit(target), F.col(ts))).alias("reached_at"))
    return g.select(key, "started", "reached_at",
                    *wait_columns(F.col("started"), F.col("reached_at"), poll_s))


def run_outcome(steps: DataFrame, by: str = "run_id", step: str = "step_no", rc: str = "rc",
                receipt: Column | None = None) -> DataFrame:
    """Per run: exit code (1 if any step failed), the first failed step, the
    number of steps, and the receipt (e.g. the volume id) only on success."""
    failed = F.col(rc) != 0
    g = steps.groupBy(by).agg(
        F.max(F.when(failed, 1).otherwise(0)).cast("int").alias("exit_code"),
        F.min(F.when(failed, F.col(step))).alias("failed_step"),
        F.count(F.lit(1)).alias("steps"))
    if receipt is not None:
        g = g.withColumn("receipt", F.when(F.col("exit_code") == 0, receipt))
    return g


def cleanup_plan(ledger: DataFrame, run: str = "run_id", kind: str = "kind",
                 order: str = "kind_order", created: str = "created_here",
                 include_volume: bool = False) -> DataFrame:
    """What each run must undo, in order: only what the run itself created,
    instance first, then group, then key. The volume is kept unless
    ``include_volume`` is set.

    The ledger is first reduced to one row per (run, kind) with a partial
    aggregate, so the numbering window sees at most one row per kind for
    each run, however many entries a run logged.
    """
    items = ledger.where(F.col(created))
    if not include_volume:
        items = items.where(F.col(kind) != F.lit("volume"))
    per_kind = items.groupBy(run, kind).agg(F.min(order).alias(order))
    w = Window.partitionBy(run).orderBy(F.col(order), F.col(kind))
    return per_kind.select(run, F.row_number().over(w).alias("step_no"), kind)
