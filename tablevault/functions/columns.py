"""Column expressions shared by the operators (all built-in Spark functions)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, MapType, StructField, StructType


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: str | Column) -> Column:
    """Shell ``[ -z "$x" ]``: unset and empty are the same thing. Works on any
    type that casts to string; a number is never empty."""
    return F.coalesce(col(c).cast("string"), F.lit("")) == F.lit("")


def blank_to_null(c: str | Column) -> Column:
    return F.nullif(col(c).cast("string"), F.lit(""))


def default_if_blank(c: str | Column, default: str) -> Column:
    return F.coalesce(blank_to_null(c), F.lit(default))


def byte_length(c: str | Column) -> Column:
    """Bytes of a string or binary value; null counts as 0."""
    return F.coalesce(F.octet_length(col(c)), F.lit(0)).cast("long")


def payload_bytes(cols: Iterable[str | Column]) -> Column:
    """Sum of the byte lengths of several payload columns."""
    parts = [byte_length(c) for c in cols]
    if not parts:
        return F.lit(0).cast("long")
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total.cast("long")


def cut_field(line: str | Column, delim: str, n: int) -> Column:
    """``cut -d DELIM -f N``: a missing field is ''; a line without the
    delimiter comes back whole."""
    c = col(line)
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(~c.contains(delim), c)
            .otherwise(F.split_part(c, F.lit(delim), F.lit(n))))


def cut_chars(line: str | Column, start: int, end: int) -> Column:
    """``cut -c START-END`` (1-based, inclusive)."""
    return F.substring(col(line), start, end - start + 1)


def first_match(line: str | Column, patterns: Sequence[tuple[str, str, int]]) -> tuple[Column, Column]:
    """First pattern in list order that matches ``line``.

    ``patterns`` are ``(name, regex, group)``. Returns ``(name, value)``
    columns, both null when nothing matches.
    """
    c = col(line)
    name = F.lit(None).cast("string")
    value = F.lit(None).cast("string")
    for pname, regex, group in reversed(list(patterns)):
        hit = c.rlike(regex)
        name = F.when(hit, F.lit(pname)).otherwise(name)
        value = F.when(hit, F.regexp_extract(c, regex, group)).otherwise(value)
    return name, value


def first_rule(rules: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """``CASE WHEN`` chain: the first true condition wins."""
    out = F.lit(default).cast("string")
    for cond, value in reversed(list(rules)):
        out = F.when(cond, F.lit(value)).otherwise(out)
    return out


def spread_salt(never_matches: Column, row_cols: Sequence[str | Column],
                buckets: int = 1 << 16) -> Column:
    """Salt for a join that keeps left rows whose key can never match.

    Rows with a null or blank key never find a partner, yet hash
    partitioning sends all of them to one task; in a request table a
    third of the rows can lack a volume. Such rows get a deterministic salt
    from their own content (a retried task computes the same value) and so
    spread over many tasks. Rows with a usable key get salt 0, as does every
    row on the other side, so real matches are unaffected.
    """
    h = F.pmod(F.xxhash64(*[col(c) for c in row_cols]), F.lit(buckets)) + 1
    return F.when(never_matches, h).otherwise(F.lit(0)).cast("long")


def hashable(c: Column, kind: DataType) -> Column:
    """A column as hash functions take it: a type with maps inside becomes JSON text,
    maps themselves as entries sorted by key, so equal maps give one text."""
    if isinstance(kind, MapType):
        return F.to_json(F.array_sort(F.map_entries(c)))
    return F.to_json(F.struct(c.alias("v"))) if "map<" in kind.simpleString() else c


def content_of(df: DataFrame) -> list[Column]:
    """All columns of a row as hash functions take them."""
    return [hashable(F.col(f"`{f.name}`"), f.dataType) for f in df.schema]


JOIN_KEY = "_tv_jk"


def join_key_type(types: Sequence[DataType]) -> StructType:
    """One struct type for both sides (all fields nullable), so the join
    compares plain attributes and no cast is put between the join and the
    partitioning it reuses."""
    fields = [StructField(f"k{i}", t, True) for i, t in enumerate(types)]
    return StructType(fields + [StructField("salt", LongType(), True)])


def salted_join_key(key_cols: Sequence[str | Column], types: Sequence[DataType],
                    never_matches: Column, row_cols: Sequence[str | Column]) -> Column:
    """Join key ``struct(keys..., salt)`` for the side whose unmatched rows
    are kept.

    The salt is part of the key itself (not a separate equality with a
    constant, which the optimizer would fold into a post-join filter), so
    hash partitioning really spreads the rows that can never match.
    """
    fields = [col(k).alias(f"k{i}") for i, k in enumerate(key_cols)]
    fields.append(spread_salt(never_matches, row_cols).alias("salt"))
    return F.struct(*fields).cast(join_key_type(types))


def plain_join_key(key_cols: Sequence[str | Column], types: Sequence[DataType]) -> Column:
    """The matching ``struct(keys..., 0)`` for the other side."""
    fields = [col(k).cast(t).alias(f"k{i}") for i, (k, t) in enumerate(zip(key_cols, types))]
    fields.append(F.lit(0).cast("long").alias("salt"))
    return F.struct(*fields).cast(join_key_type(types))


def any_null(cols: Sequence[str | Column]) -> Column:
    out = None
    for c in cols:
        cond = col(c).isNull()
        out = cond if out is None else (out | cond)
    return out if out is not None else F.lit(False)


def all_of(conds: Sequence[Column]) -> Column:
    out = None
    for c in conds:
        out = c if out is None else (out & c)
    return out if out is not None else F.lit(True)
