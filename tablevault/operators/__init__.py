"""DataFrame operators; each takes and returns DataFrames."""

from tablevault.operators.guards import (
    flag_existing,
    placement_conflicts,
    refs_missing,
    refs_present,
    validate_requests,
)
from tablevault.operators.lifecycle import (
    cleanup_plan,
    latest_entry,
    new_entries,
    run_outcome,
    wait_columns,
    wait_profile,
)
from tablevault.operators.listings import (
    extract_named_value,
    extract_tokens,
    first_pattern,
    lookup_field,
    match_lines,
    pick_fields,
)
from tablevault.operators.routing import route_first_match, route_plan, route_prepare, route_state
from tablevault.operators.sizing import (
    block_counts,
    block_layout,
    block_split,
    parse_records,
    parse_transfer,
    plan_size,
    plan_size_files,
    transfer_rate,
    volume_gib,
)
from tablevault.operators.sync import sync_apply, sync_diff, sync_report

__all__ = [
    "block_counts", "block_layout", "block_split", "volume_gib", "cleanup_plan", "extract_named_value", "extract_tokens",
    "first_pattern", "flag_existing", "latest_entry", "lookup_field", "match_lines",
    "new_entries", "parse_records", "parse_transfer", "pick_fields", "placement_conflicts",
    "plan_size", "plan_size_files", "refs_missing", "refs_present", "route_first_match", "route_plan",
    "route_prepare", "route_state", "run_outcome", "sync_apply", "sync_diff", "sync_report",
    "transfer_rate", "validate_requests", "wait_columns", "wait_profile",
]
