"""Time-to-state over a live stream with state that expires.

One keyed state for each key with reports in the last while: when it was first seen and when it was
first seen in the target state. An event-time timer removes it once the watermark has passed the
key's last report by ``expiry``, so the state follows the keys that are active and not all
keys ever seen. A key that reports again later gets a new state.

Reports behind the watermark are not dropped in silence: they leave as rows of a side output
and are written to a table of their own. Both figures of the profile are minima, so the
profile is the minimum over the updates and, if asked for, the late reports: then it
equals the batch ``wait_profile`` whatever order the reports arrived in.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tablevault.functions import constants as K
from tablevault.operators.lifecycle import wait_columns
from tablevault.session import ROCKSDB, session_conf
from tablevault.sources import fs

UPDATE, LATE = "update", "late"

# The processor travels to the Python workers whole: they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class ExpiringWait(StatefulProcessor):
    """First report and first report in the target state of one key; see the module."""

    def __init__(self, target: str, expiry_ms: int):
        self.target, self.expiry_ms = target, expiry_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # microseconds since 1970; ``due`` is the timer, in milliseconds
        self.seen = handle.getValueState("seen", "started long, reached long, last long, due long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        started, reached, last, due = self.seen.get() if self.seen.exists() else (None, None, None, None)
        before, fresh = (started, reached), False
        for chunk in rows:
            late = chunk["us"] // 1000 < watermark
            if late.any():
                gone = chunk[late]
                yield pd.DataFrame({"kind": LATE, "key": key[0], "started": gone["us"], "reached": gone["us"].where(
                    gone["state"] == self.target).astype("Int64"), "state": gone["state"]})
            chunk = chunk[~late]
            if not len(chunk):
                continue
            fresh = True
            started = min(x for x in (started, int(chunk["us"].min())) if x is not None)
            last = max(x for x in (last, int(chunk["us"].max())) if x is not None)
            there = chunk["us"][chunk["state"] == self.target]
            if len(there):
                reached = min(x for x in (reached, int(there.min())) if x is not None)
        if not fresh:
            return
        wake = last // 1000 + self.expiry_ms
        if wake != due:
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(wake)
        self.seen.update((started, reached, last, wake))
        if (started, reached) != before:
            yield pd.DataFrame({"kind": [UPDATE], "key": [key[0]], "started": [started],
                                "reached": pd.array([reached], "Int64"), "state": pd.array([None], "string")})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()  # what it knew has been written out already
        return iter([])

    def close(self) -> None:
        pass


def wait_stream_expiring(stream: DataFrame, key: str, ts: str, state: str, target: str, out_dir: str, checkpoint: str,
                         delay: str = "1 hour", expiry_s: int = 86_400, available_now: bool = True) -> StreamingQuery:
    """Start the stream. Updates go to ``<out_dir>/updates/batch=N`` and reports that arrive more
    than ``delay`` behind the newest one of earlier batches to ``<out_dir>/late/batch=N``; a
    replayed batch rewrites its folders. Reports without a key or time are left out. Timers need
    RocksDB as the state store; the query gets it, whatever the session has."""
    at = F.col(ts).cast("timestamp")
    # the watermark follows ``_tv_at``; the processor reads ``us``, so that Spark hands it late rows too
    rows = (stream.withColumn("_tv_at", at).withWatermark("_tv_at", delay)
            .select(F.col(key).alias("key"), F.unix_micros("_tv_at").alias("us"), F.col(state).alias("state")))
    kind = rows.schema["key"].dataType.simpleString()
    # reports without a time would otherwise count as on time
    usable = F.col("key").isNotNull() & F.col("us").isNotNull()
    found = rows.where(usable).groupBy("key").transformWithStateInPandas(
        ExpiringWait(target, expiry_s * 1000), outputStructType=f"kind string, key {kind}, started long, reached long, state string",
        outputMode="Update", timeMode="EventTime")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for folder, what in (("updates", UPDATE), ("late", LATE)):
                part = batch.where(F.col("kind") == what).select(
                    F.col("key").alias(key), F.timestamp_micros("started").alias("started"),
                    F.timestamp_micros("reached").alias("reached_at"), F.col("state").alias(state))
                part.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{folder}/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = found.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
    # a query keeps the settings that its session has when it starts
    with session_conf(stream.sparkSession, spark__sql__streaming__stateStore__providerClass=ROCKSDB):
        return (writer.trigger(availableNow=True) if available_now else writer).start()


def _written(spark: SparkSession, out_dir: str, folder: str) -> DataFrame | None:
    base = f"{out_dir.rstrip('/')}/{folder}"
    done = [f"{base}/{n}" for n in fs.list_dirs(spark, base) if fs.exists(spark, f"{base}/{n}/_SUCCESS")]
    return spark.read.parquet(*done) if done else None


def late_reports(spark: SparkSession, out_dir: str, key: str, ts: str = "ts") -> DataFrame | None:
    """The reports that came too late: key, time and state; None before the first batch."""
    rows = _written(spark, out_dir, "late")
    return None if rows is None else rows.withColumnRenamed("started", ts).drop("reached_at")


def expiring_result(spark: SparkSession, out_dir: str, key: str, poll_s: int = K.POLL_INTERVAL_S,
                    with_late: bool = True) -> DataFrame:
    """The profile of each key over all that was written, late reports included unless not wanted."""
    rows = _written(spark, out_dir, "updates")
    if rows is None:
        raise FileNotFoundError(f"no committed batch below {out_dir}")
    if with_late:
        rows = rows.unionByName(_written(spark, out_dir, "late"))
    g = rows.groupBy(key).agg(F.min("started").alias("started"), F.min("reached_at").alias("reached_at"))
    return g.select(key, "started", "reached_at", *wait_columns(F.col("started"), F.col("reached_at"), poll_s))
