"""Incremental sync of a keyed table into an older copy.

The copy compares a cheap signature per key (like a sync tool comparing size
and modification time), never deletes target-only rows, and lets the source
win whenever a key exists on both sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablevault.functions.columns import (
    JOIN_KEY,
    all_of,
    any_null,
    payload_bytes,
    plain_join_key,
    spread_salt,
)

SALT = "_tv_salt"
IN_SOURCE = "_tv_in_source"


def _unique_keys(df: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    """Fail the job if a non-null key repeats.

    The window is partitioned and sorted exactly as the join that follows
    needs, so the check adds no shuffle and no sort. With unique keys every
    window group is one row; a repeated key is buffered (spilling if large)
    and then fails the job.
    """
    w = Window.partitionBy(*keys, SALT).orderBy(*keys)
    bad = (F.col("_tv_rn") > 1) & ~any_null(keys)
    msg = F.lit(f"sync_diff: key {list(keys)} is not unique in the {side}")
    return (df.withColumn("_tv_rn", F.row_number().over(w))
            .filter(F.when(bad, F.raise_error(msg)).otherwise(F.lit(True)))
            .drop("_tv_rn"))


def unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df``, whose job fails if a key repeats. The window is partitioned as a join on the keys
    needs it, so the check adds a sort and no shuffle before one."""
    w = Window.partitionBy(*keys).orderBy(*keys)
    msg = F.lit(f"key {list(keys)} is not unique in the source")
    return (df.withColumn("_tv_rn", F.row_number().over(w))
            .where(F.when(F.col("_tv_rn") > 1, F.raise_error(msg)).otherwise(F.lit(True))).drop("_tv_rn"))


def _side(df: DataFrame, tag: str, keys: Sequence[str], compare_cols: Sequence[str],
          payload_cols: Sequence[str] | None) -> DataFrame:
    cols = [F.col(k) for k in keys]
    cols += [F.col(c).alias(f"_{tag}_{c}") for c in compare_cols]
    cols.append(F.lit(True).alias(f"_{tag}"))
    if payload_cols is not None:
        cols.append(payload_bytes(payload_cols).alias(f"_{tag}_bytes"))
    # the salt of keys that never match comes from columns carried anyway, so
    # the scan reads no others
    cols.append(spread_salt(any_null(keys), [*keys, *compare_cols, *(payload_cols or [])]).alias(SALT))
    return df.select(*cols)


def sync_diff(src: DataFrame, tgt: DataFrame, keys: Sequence[str], compare_cols: Sequence[str],
              payload_cols: Sequence[str] | None = None, check_unique: bool = True, target_repeats: bool = False) -> DataFrame:
    """Class of every key: ``new``, ``changed``, ``unchanged`` or ``target_only``.

    A key that repeats fails the job. With ``target_repeats`` it may repeat in the target:
    each of its rows there is compared and gives a row.

    ``compare_cols`` is the signature; nulls compare equal. A null key matches
    nothing: such rows are ``new`` or ``target_only``. With
    ``payload_cols`` a ``bytes`` column holds the payload size of the row that
    wins (the source row, or the target row for ``target_only``).

    Only keys, the signature and one byte count cross the shuffle; both sides
    are hash-partitioned on the keys once (sort-merge full outer join), or
    one side is broadcast when Spark's size estimate allows it.
    """
    keys, compare_cols = list(keys), list(compare_cols)
    s = _side(src, "s", keys, compare_cols, payload_cols)
    t = _side(tgt, "t", keys, compare_cols, payload_cols)
    if check_unique:
        s = _unique_keys(s, keys, "source")
    if check_unique and not target_repeats:
        t = _unique_keys(t, keys, "target")
    j = s.join(t, on=keys + [SALT], how="full_outer")
    same = all_of([F.col(f"_s_{c}").eqNullSafe(F.col(f"_t_{c}")) for c in compare_cols])
    cls = (F.when(F.col("_t").isNull(), F.lit("new"))
           .when(F.col("_s").isNull(), F.lit("target_only"))
           .when(same, F.lit("unchanged"))
           .otherwise(F.lit("changed")))
    out = [F.col(k) for k in keys] + [cls.alias("cls")]
    if payload_cols is not None:
        out.append(F.when(F.col("_s"), F.col("_s_bytes")).otherwise(F.col("_t_bytes")).alias("bytes"))
    return j.select(*out)


def null_key_leftovers(src: DataFrame, tgt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows with a null key beyond those that equal a source row.

    Such rows have no identity but their content: each source row stands for
    one equal target row, the others stay. Equal rows are counted (partial on
    every map task) before anything is shuffled.
    """
    sides = [df.where(any_null(list(keys))).withColumn("_tv_n", F.lit(n)) for df, n in ((tgt, 1), (src, -1))]
    both = sides[0].unionByName(sides[1], allowMissingColumns=True)
    cols = [c for c in both.columns if c != "_tv_n"]
    left = both.groupBy(*cols).agg(F.sum("_tv_n").alias("_tv_n")).where(F.col("_tv_n") > 0)
    return left.withColumn("_tv_n", F.explode(F.sequence(F.lit(1), F.col("_tv_n").cast("int")))).drop("_tv_n")


def sync_apply(src: DataFrame, tgt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after a sync without deletes: every source row, plus the
    target rows whose key the source lacks.

    The source side of the join is reduced to its distinct keys (map-side
    partial aggregation, same partitioning as the join, so no extra shuffle).
    It is an outer join with a filter: an anti join would be pushed into each branch of
    a target that is a union, and the one of a small branch meets all source keys in few
    tasks, as partitions are put together by their compressed sizes.
    A null key matches no key; such target rows stay unless the source holds
    an equal row (see ``null_key_leftovers``). So applying it twice gives the
    same table as applying it once, null keys included.
    """
    keys = list(keys)
    types = [tgt.schema[k].dataType for k in keys]
    src_keys = (src.where(~any_null(keys)).select(plain_join_key(keys, types).alias(JOIN_KEY)).distinct()
                .withColumn(IN_SOURCE, F.lit(True)))
    kept = (tgt.where(~any_null(keys)).withColumn(JOIN_KEY, plain_join_key(keys, types))
            .join(src_keys, on=JOIN_KEY, how="left").where(F.col(IN_SOURCE).isNull())
            .drop(JOIN_KEY, IN_SOURCE))
    out = src.unionByName(kept, allowMissingColumns=True)
    if not any(tgt.schema[k].nullable for k in keys):
        return out
    return out.unionByName(null_key_leftovers(src, tgt, keys), allowMissingColumns=True)


def sync_report(diff: DataFrame, cls_col: str = "cls", bytes_col: str | None = "bytes") -> DataFrame:
    """Rows and bytes per class; ``new`` + ``changed`` is what a sync sends."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    if bytes_col is not None:
        aggs.append(F.coalesce(F.sum(bytes_col), F.lit(0)).cast("long").alias("bytes"))
    return diff.groupBy(cls_col).agg(*aggs)
