"""Reference and placement checks.

Existence tests are semi/anti/left joins against the *distinct* keys of the
inventory: the aggregate is partial on every map task, so a key repeated many
times in the inventory collapses before the shuffle and cannot multiply rows,
and AQE can split a hot request key that does match. Request rows whose key
is null or blank can never match; their join key carries a salt so that such
a group (a third of all requests may lack a volume) spreads over many tasks
instead of one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablevault.functions import constants as K
from tablevault.functions.columns import (
    JOIN_KEY,
    content_of,
    default_if_blank,
    first_rule,
    is_blank,
    plain_join_key,
    salted_join_key,
)


def _blank(c: str | Column) -> Column:
    return is_blank(c)


def _distinct_keys(ref: DataFrame, ref_on: str, like: DataFrame, on: str) -> DataFrame:
    """Distinct usable keys of ``ref`` as ``struct(key, 0)``, typed like ``like[on]``.

    The distinct is partial on every map task, so a key repeated many times
    in the inventory collapses before it is shuffled. It runs on the plain
    key and the struct is built after it, so the join shuffles the distinct
    keys once more on its own key: that plain shuffle stage is what AQE
    needs to split a hot key on the request side (a skewed partition is
    split and its few inventory keys are replicated). The extra shuffle
    moves distinct keys only.
    """
    t = like.schema[on].dataType
    distinct = (ref.where(~_blank(ref_on)).select(F.col(ref_on).cast(t).alias("_tv_k")).distinct())
    return distinct.select(plain_join_key(["_tv_k"], [t]).alias(JOIN_KEY))


def _salted(df: DataFrame, on: str) -> DataFrame:
    t = [df.schema[on].dataType]
    return df.withColumn(JOIN_KEY, salted_join_key([on], t, _blank(on), content_of(df)))


def refs_present(df: DataFrame, ref: DataFrame, on: str, ref_on: str | None = None) -> DataFrame:
    """Rows whose reference exists in ``ref`` (left semi join). Rows with a
    null or blank reference cannot match and are dropped before the shuffle."""
    keys = _distinct_keys(ref, ref_on or on, df, on)
    left = df.where(~_blank(on)).withColumn(JOIN_KEY, plain_join_key([on], [df.schema[on].dataType]))
    return left.join(keys, on=JOIN_KEY, how="left_semi").drop(JOIN_KEY)


def refs_missing(df: DataFrame, ref: DataFrame, on: str, ref_on: str | None = None) -> DataFrame:
    """Rows whose reference does not exist; a null or blank reference is
    missing, so ``refs_present`` and ``refs_missing`` split the input."""
    keys = _distinct_keys(ref, ref_on or on, df, on)
    return _salted(df, on).join(keys, on=JOIN_KEY, how="left_anti").drop(JOIN_KEY)


def flag_existing(df: DataFrame, ref: DataFrame, on: str, ref_on: str, flag: str) -> DataFrame:
    """Adds boolean ``flag``: does ``df[on]`` exist in ``ref[ref_on]``?
    A left join against distinct keys, so rows are never multiplied."""
    keys = _distinct_keys(ref, ref_on, df, on).withColumn(flag, F.lit(True))
    j = _salted(df, on).join(keys, on=JOIN_KEY, how="left")
    return j.select(*df.columns, F.coalesce(F.col(flag), F.lit(False)).alias(flag))


def validate_requests(req: DataFrame, volumes: DataFrame, sources: DataFrame, *,
                      method: str = "method", volume: str = "volume_id", source: str = "source_id",
                      volumes_key: str = "volume_id", sources_key: str = "source_id") -> DataFrame:
    """First failing rule per request, in this order:
    ``bad_method`` -> ``volume_blank`` -> ``volume_unknown`` ->
    ``source_missing`` -> ``source_unknown`` -> ``ok``.

    A blank method means ``dd``. A null volume is legal (one gets created);
    an empty one is not.
    """
    m = default_if_blank(method, K.DEFAULT_METHOD)
    checked = flag_existing(req, volumes, volume, volumes_key, "_tv_volume_known")
    checked = flag_existing(checked, sources, source, sources_key, "_tv_source_known")
    vol = F.col(volume)
    verdict = first_rule([
        (~m.isin(*K.METHODS), "bad_method"),
        (vol.isNotNull() & _blank(volume), "volume_blank"),
        (vol.isNotNull() & ~F.col("_tv_volume_known"), "volume_unknown"),
        (_blank(source), "source_missing"),
        (~F.col("_tv_source_known"), "source_unknown"),
    ], default="ok")
    keep = [c for c in req.columns if c != method]
    return checked.select(*keep, m.alias(method), verdict.alias("verdict"))


def placement_conflicts(req: DataFrame, volumes: DataFrame, workers: DataFrame, *,
                        volume: str = "volume_id", worker_key: str = "source_id",
                        keep: Sequence[str] = ("request_id",)) -> DataFrame:
    """Requests whose user-supplied volume sits in another zone than the
    worker that would attach it. Created volumes take the worker's zone and
    cannot conflict, so only rows with a volume are joined (inner joins drop
    null keys before the shuffle). Zones compare like shell strings: unset
    equals empty. Inventories are reduced to distinct entries first, so one
    listed twice does not repeat a conflict."""
    v = volumes.select(F.col("volume_id").alias(volume), F.col("zone").alias("volume_zone")).distinct()
    w = workers.select(F.col(worker_key), "instance_id", F.col("zone").alias("instance_zone")).distinct()
    j = (req.where(~is_blank(volume)).select(*keep, volume, worker_key)
         .join(v, on=volume, how="inner")
         .join(w, on=worker_key, how="inner"))
    differ = F.coalesce(F.col("volume_zone"), F.lit("")) != F.coalesce(F.col("instance_zone"), F.lit(""))
    return j.where(differ).select(*keep, volume, "instance_id", "volume_zone", "instance_zone")
