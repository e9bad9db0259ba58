"""Extraction over tables of text lines (O11-O15, O23d).

Cloud listings and kernel logs arrive as lines of text; ids, zones and
fields are pulled out with Spark's regex and split functions, so all of it
runs in generated code next to the scan. Whole lines are always processed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablevault.functions.columns import all_of, cut_chars, cut_field, first_match


def match_lines(df: DataFrame, col: str, patterns: Sequence[str]) -> DataFrame:
    """Rows whose ``col`` matches every pattern (unanchored, case-sensitive),
    like chained ``grep``s. Callers quote literal ids with ``\\Q..\\E``."""
    return df.where(all_of([F.col(col).rlike(p) for p in patterns]))


def extract_tokens(df: DataFrame, id_cols: Sequence[str], col: str, pattern: str,
                   group: int = 0) -> DataFrame:
    """Every non-overlapping match on every row, left to right, one row each:
    ``(ids..., pos, token)`` with ``pos`` counted from 0. ``group`` picks a
    capture group (0 = the whole match)."""
    found = F.regexp_extract_all(F.col(col), F.lit(pattern), F.lit(group))
    return df.select(*id_cols, F.posexplode(found).alias("pos", "token"))


def pick_fields(df: DataFrame, col: str, delim: str = "\t",
                fields: Mapping[str, int] | None = None,
                chars: Mapping[str, tuple[int, int]] | None = None,
                keep: Sequence[str] = ()) -> DataFrame:
    """Named columns cut from delimited or fixed-width lines (``cut -f`` /
    ``cut -c``): a missing field is ``''``; a line without the delimiter is
    returned whole for every field."""
    out = [F.col(k) for k in keep]
    for name, n in (fields or {}).items():
        out.append(cut_field(col, delim, n).alias(name))
    for name, (a, b) in (chars or {}).items():
        out.append(cut_chars(col, a, b).alias(name))
    return df.select(*out)


def named_value_pattern(name: str, quoted: bool = True) -> str:
    """Regex for ``"name": "word"`` (one space after the colon, a single
    ``\\w+`` word); ``quoted=False`` takes a bare word such as a number."""
    key = '"' + "".join("\\" + ch if not ch.isalnum() and ch != "_" else ch for ch in name) + '"'
    return key + (r': "(\w+)"' if quoted else r": (\w+)")


def extract_named_value(df: DataFrame, id_cols: Sequence[str], col: str, name: str,
                        quoted: bool = True) -> DataFrame:
    """Value of a named JSON-ish field, scraped as text: rows that do not
    carry the field are dropped, as ``egrep`` drops them."""
    pat = named_value_pattern(name, quoted)
    return (df.where(F.col(col).rlike(pat))
            .select(*id_cols, F.regexp_extract(F.col(col), pat, 1).alias("value")))


def lookup_field(df: DataFrame, listing: DataFrame, on: Sequence[str] | str,
                 fields: Sequence[str]) -> DataFrame:
    """Fetch fields of the listing row(s) with the same id (inner equi-join).

    Several listing rows for one id give several output rows. Only the id and
    the wanted fields of the listing are read; Spark broadcasts the listing
    when its size estimate is under the broadcast threshold and otherwise
    shuffles both sides (AQE splits skewed ids).
    """
    on = [on] if isinstance(on, str) else list(on)
    return df.join(listing.select(*on, *fields), on=on, how="inner")


def first_pattern(df: DataFrame, col: str, patterns: Sequence[tuple[str, str, int]],
                  keep: Sequence[str] = (), name_col: str = "pattern",
                  value_col: str = "value") -> DataFrame:
    """The first pattern, in listed order, that matches each row, and what it
    matched; both null when none does."""
    name, value = first_match(col, patterns)
    return df.select(*keep, name.alias(name_col), value.alias(value_col))
