"""Structured Streaming operators."""

from tablevault.streaming.versioned_sync import (
    apply_batch,
    bucket_versions,
    read_bucketed,
    read_synced,
    superseded_versions,
    sync_stream,
)
from tablevault.streaming.expiring_wait import expiring_result, late_reports, wait_stream_expiring
from tablevault.streaming.state_wait import (
    compact_updates,
    wait_stream,
    wait_stream_result,
    wait_updates,
)

__all__ = ["apply_batch", "bucket_versions", "compact_updates", "expiring_result", "late_reports", "read_bucketed", "read_synced", "superseded_versions",
           "sync_stream", "wait_stream", "wait_stream_expiring", "wait_stream_result",
           "wait_updates"]
