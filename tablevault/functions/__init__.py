"""Column-level helpers and fixed values."""

from tablevault.functions import constants
from tablevault.functions.columns import (
    all_of,
    any_null,
    blank_to_null,
    byte_length,
    cut_chars,
    cut_field,
    default_if_blank,
    first_match,
    first_rule,
    is_blank,
    payload_bytes,
    plain_join_key,
    salted_join_key,
    spread_salt,
)

__all__ = [
    "constants", "blank_to_null", "byte_length", "cut_chars", "cut_field",
    "default_if_blank", "first_match", "first_rule", "is_blank", "payload_bytes",
    "spread_salt", "all_of", "any_null", "plain_join_key", "salted_join_key",
]
