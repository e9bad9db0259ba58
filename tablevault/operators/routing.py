"""Ordered rule lists: the first rule that holds decides (O23a-c).

Each router is one ``CASE WHEN`` chain built from a fixed rule table, so it
stays inside generated code; ``route_prepare`` adds one left join to look up
what the volume holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
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


def route_first_match(df: DataFrame, rules, out: str, default: str | None = None) -> DataFrame:
    """Generic router: ``rules`` is a list of ``(condition Column, value)``."""
    return df.withColumn(out, first_rule(rules, default))


def route_plan(df: DataFrame, method: str = "method", volume: str = "volume_id",
               out: str = "plan") -> DataFrame:
    """Method and volume -> plan: dd+volume a, dd b, rsync+volume c, rsync d;
    any other method gets null. A blank method means dd."""
    m = default_if_blank(method, K.DEFAULT_METHOD)
    has_volume = ~is_blank(volume)
    rules = [((m == F.lit(meth)) & (has_volume if with_vol else ~has_volume), letter)
             for meth, with_vol, letter in K.PLAN_RULES]
    return df.withColumn(out, first_rule(rules))


def route_prepare(df: DataFrame, volumes: DataFrame, volume: str = "volume_id",
                  out: str = "action") -> DataFrame:
    """What to do with the target volume before copying:
    none given -> ``create``; not in the inventory -> ``reject``; raw
    content -> ``format_mount``; a supported filesystem -> ``mount``;
    anything else -> ``rollback``. The same rules for both methods.

    The inventory is reduced to one row per volume id (partial aggregate)
    before the left join, so a repeated id cannot multiply requests; AQE can
    split a hot request volume.
    """
    t = [df.schema[volume].dataType]
    # grouped on the plain id, the struct key built after: the join then
    # shuffles this side on its own key, a plain stage AQE can skew-split
    inv = (volumes.where(~is_blank("volume_id"))
           .groupBy(F.col("volume_id").cast(t[0]).alias("_tv_vid"))
           .agg(F.min("fs").alias("_tv_fs"))
           .select(plain_join_key(["_tv_vid"], t).alias(JOIN_KEY), "_tv_fs",
                   F.lit(True).alias("_tv_found")))
    left = df.withColumn(JOIN_KEY, salted_join_key([volume], t, is_blank(volume), content_of(df)))
    j = left.join(inv, on=JOIN_KEY, how="left")
    fs = F.col("_tv_fs")
    action = first_rule([
        (is_blank(volume), "create"),
        (F.col("_tv_found").isNull(), "reject"),
        (fs == F.lit(K.RAW_CONTENT), "format_mount"),
        (fs.isin(*K.SUPPORTED_FILESYSTEMS), "mount"),
    ], default="rollback")
    # a request's own column of that name gives way to the inventory's
    return j.select(*[F.col(f"`{c}`") for c in df.columns if c != "fs"], fs.alias("fs"), action.alias(out))


def route_state(df: DataFrame, state: str = "state", out: str = "action") -> DataFrame:
    """Instance state -> action: running proceed, pending wait, stopped start;
    any other state gets null."""
    rules = [(F.col(state) == F.lit(s), a) for s, a in K.STATE_ACTIONS]
    return df.withColumn(out, first_rule(rules))
