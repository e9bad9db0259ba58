"""Repeated syncs into one target as micro-batches.

Every micro-batch is one sync: inside the batch the row with the highest
``order_col`` wins per key, and rows with a null key are all kept; the batch is
then applied, source-wins and without deletes, to the newest committed state of
the target, whoever wrote it (a full copy, a batch sync or another stream), and
the result becomes the next version.

Versions have numbers of their own. A version's manifest holds the last batch
taken from each stream, so a replayed batch is recognised and skipped, and a new
stream (a fresh checkpoint) on an old target just goes on from its state. Reading
the state from storage keeps the lineage one batch deep.

Two layouts (both can drop versions that newer ones fully replace, with
``keep_history=False``):

* ``buckets=None``: every version is the whole table.
* ``buckets=B``: a version holds only the key buckets its batch touched, each
  split into files by row count (see ``sources.snapshot.write_buckets``).
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tablevault.functions.columns import any_null
from tablevault.operators.lifecycle import latest_entry
from tablevault.operators.sync import sync_apply
from tablevault.sources import fs
from tablevault.sources.snapshot import (
    BUCKET,
    MANIFEST,
    State,
    bucket_of,
    drop_unused,
    next_version,
    read_rows,
    read_state,
    version_path,
    write_buckets,
)


def bucket_versions(spark: SparkSession, target: str, below: int | None = None) -> dict[int, int]:
    """Newest committed version of every bucket written (metadata only)."""
    return read_state(spark, target, None if below is None else below - 1).buckets


def read_bucketed(spark: SparkSession, target: str, only: Iterable[int] | None = None,
                  below: int | None = None) -> DataFrame | None:
    """The table (or some of its buckets) as of the versions below ``below``."""
    state = read_state(spark, target, None if below is None else below - 1)
    return None if state.version is None else read_rows(spark, target, state, None if only is None else list(only))


def superseded_versions(spark: SparkSession, target: str, below: int) -> list[int]:
    """Committed versions below ``below`` that the state there does not refer to."""
    state = read_state(spark, target, below - 1)
    used = {state.version, state.whole, *state.buckets.values()}
    return [v for v in fs.versions(spark, target) if v < below and v not in used]


def apply_batch(batch: DataFrame, batch_id: int, target: str, keys: Sequence[str],
                order_col: str, buckets: int | None = None, keep_history: bool = True,
                stream_id: str = "direct") -> None:
    """Apply one micro-batch; does nothing if this stream's batch is in already."""
    spark = batch.sparkSession
    keys = list(keys)
    state = read_state(spark, target)
    if state.streams.get(stream_id, -1) >= batch_id:
        return
    incoming = latest_entry(batch.where(~any_null(keys)), keys, [order_col]).select(*batch.columns)
    if any(batch.schema[k].nullable for k in keys):
        incoming = incoming.unionByName(batch.where(any_null(keys)))
    version = next_version(spark, target, first=0)
    if buckets is None:
        prev = None if state.version is None else read_rows(spark, target, state)
        merged = incoming if prev is None else sync_apply(incoming, prev, keys)
        streams = {**state.streams, stream_id: batch_id}
        path = version_path(target, version)
        fs.write_text(spark, f"{path}/{MANIFEST}", json.dumps(
            {"whole": version, "buckets": {}, "n": None, "keys": [], "streams": streams}))
        merged.write.mode("append").parquet(path)
        after = State(version, version, {}, None, [], streams)
    else:
        after = write_buckets(incoming, target, keys, buckets, state, version, {stream_id: batch_id})
    if not keep_history:
        drop_unused(spark, target, after)


def read_synced(spark: SparkSession, target: str, buckets: int | None = None,
                schema: StructType | None = None) -> DataFrame:
    """The current table below ``target``. With ``schema``, a committed but empty
    one reads as an empty DataFrame."""
    state = read_state(spark, target)
    rows = None if state.version is None else read_rows(spark, target, state)
    if rows is not None:
        return rows
    if schema is not None and state.version is not None:
        return spark.createDataFrame([], schema)
    raise FileNotFoundError(f"no committed version below {target}")


def stream_of(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the query when its checkpoint was made."""
    text = fs.read_text(spark, f"{checkpoint.rstrip('/')}/metadata")
    if text is None:
        raise FileNotFoundError(f"no stream metadata below {checkpoint}")
    return json.loads(text)["id"]


def sync_stream(stream: DataFrame, target: str, keys: Sequence[str], order_col: str,
                checkpoint: str, buckets: int | None = None, available_now: bool = True,
                processing_time: str | None = None, keep_history: bool = True) -> StreamingQuery:
    """Start the sync; ``available_now`` drains what is there and stops.
    ``keep_history=False`` deletes versions that newer ones fully replace,
    so storage and the per-batch listing stay bounded. One writer at a time
    may work on a target."""
    keys = list(keys)
    writer = (stream.writeStream
              .foreachBatch(lambda df, bid: apply_batch(df, bid, target, keys, order_col, buckets, keep_history,
                                                        stream_of(df.sparkSession, checkpoint)))
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


__all__ = ["BUCKET", "apply_batch", "bucket_of", "bucket_versions", "read_bucketed", "read_synced", "stream_of",
           "superseded_versions", "sync_stream"]
