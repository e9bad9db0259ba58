"""What to undo first, from dependencies.

An item can be undone once everything that needs it has been undone. Items that nothing
needs are layer 0, those needed by layer 0 alone are layer 1, and so on: the layer is the
length of the longest chain of items above. Items in a cycle, and what they need, are never
free; they are reported instead of looping.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablevault.session import new_work_dir
from tablevault.sources import fs

STEPS = 3  # layers that are peeled off between two writes; the plan doubles with each


def cleanup_layers(items: DataFrame, needs: DataFrame, by: Sequence[str], item: str, on: str = "needs") -> DataFrame:
    """``(by.., item, layer, cyclic)`` of every distinct row of ``items``.

    ``needs`` has rows ``(by.., item, on)``: ``item`` cannot outlive ``on``. Rows that name an item
    not in ``items``, an item that needs itself, or a null do not count, and repeated ones count
    once. Within a peel each remaining item looks only at what still needs it; ``STEPS``
    peels run in one job, whose result is written to the shared folder, so a chain of ``n`` items
    costs ``n / STEPS`` jobs and a lost executor the last one.
    """
    spark, by = items.sparkSession, list(by)
    work = new_work_dir(spark, "layers")
    key = F.struct(*[F.col(c).alias(f"b{k}") for k, c in enumerate(by)], F.col(item).cast("string").alias("item"))
    far = F.struct(*[F.col(c).alias(f"b{k}") for k, c in enumerate(by)], F.col(on).cast("string").alias("item"))
    nodes = items.select(*by, item).distinct()
    named = nodes.where(F.col(item).isNotNull()).select(key.alias("node"))
    edges = needs.where(F.col(item).cast("string") != F.col(on).cast("string")).select(key.alias("above"), far.alias("node")).distinct()
    edges = edges.join(named.withColumnRenamed("node", "above"), "above", "left_semi").join(named, "node", "left_semi")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{work}/{name}")
        return spark.read.schema(df.schema).parquet(f"{work}/{name}")

    edges = written(edges.select("above", "node"), "edges-0")
    left, done, layer, turn = written(named, "left-0"), [], 0, 0
    while not left.isEmpty():
        turn += 1
        peeled, rest, open_ = None, left, edges
        for _ in range(STEPS):
            # partial counts: an item that a third of all others need is added up first
            held = open_.select("node").distinct()
            free = rest.join(held, "node", "left_anti").withColumn("layer", F.lit(layer))
            peeled = free if peeled is None else peeled.unionByName(free)
            rest = rest.join(held, "node", "left_semi")
            # of an edge that still holds something, the upper end is held too
            open_ = open_.join(held.withColumnRenamed("node", "above"), "above", "left_semi")
            layer += 1
        peeled = written(peeled, f"peeled-{turn}")
        if peeled.isEmpty():
            break  # what is left waits for itself
        done.append(f"{work}/peeled-{turn}")
        gone = peeled.select("node")
        left = written(left.join(gone, "node", "left_anti"), f"left-{turn}")
        edges = written(edges.join(gone.withColumnRenamed("node", "above"), "above", "left_anti"), f"edges-{turn}")
        for name in ("left", "edges"):
            fs.delete(spark, f"{work}/{name}-{turn - 1}")
    if not done:
        found = nodes.limit(0).select(key.alias("node")).withColumn("layer", F.lit(0))
    else:
        found = spark.read.parquet(*done)
    return nodes.withColumn("node", key).join(found, "node", "left").select(
        *by, item, "layer", (F.col("layer").isNull() & F.col(item).isNotNull()).alias("cyclic"))
