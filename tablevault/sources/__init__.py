"""Sources and sinks: input tables, text listings, file listings, snapshots."""

from tablevault.sources.snapshot import (
    latest_version,
    read_snapshot,
    read_tolerant,
    snapshot_full,
    snapshot_tolerant,
    sync_run,
    version_path,
)
from tablevault.sources.tables import TABLES, file_listing, table, text_lines

__all__ = ["TABLES", "file_listing", "latest_version", "read_snapshot", "read_tolerant",
           "snapshot_full", "snapshot_tolerant", "sync_run", "table", "text_lines", "version_path"]
