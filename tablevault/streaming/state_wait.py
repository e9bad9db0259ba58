"""Time-to-state over a live stream of state reports.

Two forms, with the same answer as the batch ``wait_profile`` whatever order the
events arrive in:

* with state (the default): a streaming ``groupBy`` keeps, per key, the first time
  seen and the first time the target state was seen (RocksDB state store, one
  small row per key ever seen, never removed) and emits the keys each micro-batch
  changed; ``expiring_wait`` is the form whose state follows the active keys;
* without (``keep_state=False``): every micro-batch emits the two minima of its own
  events. Nothing is kept between batches, so there is nothing to evict and no
  event is too late.

Both figures are minima, so the answer per key is the minimum over everything
emitted. Batches are written as ``batch=<id>`` (a replay rewrites its own folder);
every ``compact_every`` batches what lies there is folded into one folder, so a
reader meets a bounded number of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablevault.functions import constants as K
from tablevault.operators.lifecycle import wait_columns
from tablevault.sources import fs

COMPACT_EVERY = 16


def wait_updates(stream: DataFrame, key: str, ts: str, state: str, target: str) -> DataFrame:
    return stream.groupBy(key).agg(
        F.min(ts).alias("started"),
        F.min(F.when(F.col(state) == F.lit(target), F.col(ts))).alias("reached_at"))


def _folders(spark: SparkSession, out_dir: str) -> list[str]:
    base = out_dir.rstrip("/")
    names = [n for n in fs.list_dirs(spark, base) if n.startswith(("batch=", "folded="))]
    return [f"{base}/{n}" for n in names if fs.exists(spark, f"{base}/{n}/_SUCCESS")]


def _fold(updates: DataFrame, key: str) -> DataFrame:
    return updates.groupBy(key).agg(F.min("started").alias("started"), F.min("reached_at").alias("reached_at"))


def compact_updates(spark: SparkSession, out_dir: str, key: str) -> None:
    """Fold all emitted updates into one folder. The old ones go once it is
    committed; until then, or if some stay, reading both gives the same minima."""
    old = _folders(spark, out_dir)
    if len(old) > 1:
        new = f"{out_dir.rstrip('/')}/folded={uuid.uuid4().hex}"
        _fold(spark.read.parquet(*old), key).write.parquet(new)
        for path in old:
            fs.delete(spark, path)


def wait_stream(stream: DataFrame, key: str, ts: str, state: str, target: str, out_dir: str,
                checkpoint: str, available_now: bool = True,
                keep_state: bool = True, compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Start the wait profile stream; see above for ``keep_state``."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        out = batch if keep_state else wait_updates(batch, key, ts, state, target)
        out.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            compact_updates(batch.sparkSession, out_dir, key)

    updates = wait_updates(stream, key, ts, state, target) if keep_state else stream
    writer = (updates.writeStream.outputMode("update" if keep_state else "append").foreachBatch(sink)
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def wait_stream_result(spark: SparkSession, out_dir: str, key: str,
                       poll_s: int = K.POLL_INTERVAL_S) -> DataFrame:
    """Fold the emitted updates into the final profile per key."""
    g = _fold(spark.read.parquet(*_folders(spark, out_dir)), key)
    return g.select(key, "started", "reached_at",
                    *wait_columns(F.col("started"), F.col("reached_at"), poll_s))
