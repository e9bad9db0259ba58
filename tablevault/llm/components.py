"""Connected components of a table of links, by Spark joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablevault.llm.common import written


def _are_stars(pairs: DataFrame) -> bool:
    """Whether every larger end has one link, and no smaller end is a larger one too."""
    ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        pairs.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node in ``links``; a component is named by
    its smallest node.

    Alternates two steps until the links are stars around their smallest nodes:
    every node links its larger neighbours to the smallest node it knows, then
    its smaller ones. Each round is written to the shared folder. Null ends and
    loops are ignored; no links give no rows.
    """
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    pairs = written(pairs, "links")
    while not _are_stars(pairs):
        # larger neighbours: v is the far end, m the smallest of u's neighbours and u
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        # smaller neighbours and the node itself
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct("u", F.col("m").alias("v")))).alias("p")).select("p.u", "p.v")
        pairs = written(small.where("u > v").distinct(), "links")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
