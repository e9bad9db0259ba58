"""Many literal patterns as a table (O11), and set sketches in front of existence tests.

A chain of ``rlike`` grows the plan with every pattern. Here the patterns are rows: a line
that holds a literal holds every piece of it, so each pattern is looked up by one piece,
the one that is rarest in the lines, and only lines with that piece are searched for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablevault.functions.columns import is_blank
from tablevault.operators.guards import refs_missing

EMPTY_SALTS = 16
SIZES = (1, 2, 4, 8)  # code points of a piece; a pattern uses the longest that fits in it


def _pieces(text: Column, size: int) -> Column:
    """Distinct pieces of ``size`` code points; a shorter text has none."""
    n = F.length(text) - size + 1
    return F.when(n > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), n), lambda i: F.substr(text, i, F.lit(size)))))


def match_lines_table(lines: DataFrame, id_cols: Sequence[str], col: str, patterns: DataFrame, pattern_id: str = "pattern_id",
                      literal: str = "literal") -> DataFrame:
    """``(id_cols.., pattern_id)`` of every line and every literal that stands in it, once each.

    Pieces of lines are kept only if a pattern has them, counted (added up before the
    shuffle) to find each pattern's rarest, and joined with that alone; what is
    found is verified in the line. Patterns whose rarest piece no line has match
    nothing. Equal literals are looked up once. A null line or literal matches nothing, an
    empty literal every line that is not null.
    """
    ids = list(id_cols)
    size = F.greatest(*[F.when(F.length("_lit") >= s, s).otherwise(0) for s in SIZES])
    named = patterns.select(F.col(pattern_id).alias("_pid"), F.col(literal).alias("_lit")).where(F.col(literal).isNotNull())
    lits = named.select("_lit").distinct()
    wanted = lits.withColumn("_size", size).where("_size > 0").select("_lit", F.explode(F.coalesce(*[
        F.when(F.col("_size") == s, _pieces(F.col("_lit"), s)) for s in SIZES])).alias("_piece"))
    known = wanted.select("_piece").distinct()
    text = lines.select(*[F.col(c).alias(f"_id{k}") for k, c in enumerate(ids)], F.col(col).alias("_line")).where(F.col(col).isNotNull())
    held = text.select(*[f"_id{k}" for k in range(len(ids))], "_line",
                       F.explode(F.concat(*[F.coalesce(_pieces(F.col("_line"), s), F.array().cast("array<string>")) for s in SIZES])).alias("_piece"))
    held = held.join(known, "_piece", "left_semi")
    counts = held.groupBy("_piece").agg(F.count("*").alias("_n"))
    # a piece that no line has is the rarest of all: its pattern matches nothing
    rarest = wanted.join(counts, "_piece", "left").groupBy("_lit").agg(
        F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_piece").alias("piece"))).alias("_r")).where("_r.n > 0")
    found = held.join(rarest.select("_lit", F.col("_r.piece").alias("_piece")), "_piece").where(F.contains("_line", "_lit"))
    cols = [F.col(f"_id{k}").alias(c) for k, c in enumerate(ids)]
    out = found.join(named, "_lit").select(*cols, F.col("_pid").alias(pattern_id))
    # an empty literal has no piece; every line takes it from one of a few copies
    salt = F.explode(F.sequence(F.lit(0), F.lit(EMPTY_SALTS - 1)))
    empty = named.where("_lit = ''").select(F.col("_pid").alias(pattern_id), salt.alias("_salt"))
    every = text.withColumn("_salt", F.pmod(F.xxhash64("_line", *[f"_id{k}" for k in range(len(ids))]), F.lit(EMPTY_SALTS)).cast("int"))
    every = every.join(empty, "_salt").select(*cols, pattern_id)
    return out.unionByName(every).distinct()


# ------------------------------------------------------------------ sketches of an inventory

FILTER_BITS = 1 << 24  # of one filter: 2 MB, whatever the inventory's size
HASHES = 2


def _positions(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(k), key.cast("string")), F.lit(bits)) for k in range(HASHES)]


def inventory_filter(ref: DataFrame, on: str, bits: int = FILTER_BITS) -> DataFrame:
    """A Bloom filter of the keys of an inventory as rows ``(bucket, bitmap)``.

    Bitmaps are or-ed on every map task, so the shuffle carries at most ``bits / 8`` bytes for each.
    With ``n`` distinct keys an absent key looks present with ``(1 - exp(-2 n / bits)) ** 2``; a key
    that is there is never missed. Blank keys are not in it.
    """
    at = ref.where(~is_blank(on)).select(F.explode(F.array(*_positions(F.col(on), bits))).alias("at"))
    # bitmap functions count positions from 1
    return at.groupBy(F.bitmap_bucket_number(F.col("at") + 1).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("at") + 1)).alias("bitmap"))


def merge_filters(filters: Sequence[DataFrame]) -> DataFrame:
    """The filter of all inventories together, from the filters of each (of one size)."""
    rows = filters[0]
    for more in filters[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def filter_error(n: int, bits: int = FILTER_BITS) -> float:
    """The share of absent keys that look present with ``n`` distinct keys in the filter."""
    import math

    return (1 - math.exp(-HASHES * n / bits)) ** HASHES


def maybe_present(df: DataFrame, on: str, sketch: DataFrame, flag: str, bits: int = FILTER_BITS) -> DataFrame:
    """``df`` with boolean ``flag``: false if the filter says that ``df[on]`` is not in the inventory. The
    filter is broadcast; its size is ``bits`` and does not follow the inventory."""
    out, tests = df, []
    for k, at in enumerate(_positions(F.col(on), bits)):
        side = F.broadcast(sketch.select(F.col("bucket").alias(f"_tv_b{k}"), F.col("bitmap").alias(f"_tv_m{k}")))
        out = out.join(side, F.bitmap_bucket_number(at + 1) == F.col(f"_tv_b{k}"), "left")
        place = F.bitmap_bit_position(at + 1)
        byte = F.conv(F.hex(F.substr(F.col(f"_tv_m{k}"), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        tests.append(F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) != 0, F.lit(False)))
    hit = tests[0]
    for t in tests[1:]:
        hit = hit & t
    return out.withColumn(flag, hit & ~is_blank(on)).drop(*[f"_tv_{x}{k}" for k in range(HASHES) for x in "bm"])


def refs_missing_prefiltered(df: DataFrame, ref: DataFrame, on: str, ref_on: str | None = None, sketch: DataFrame | None = None,
                             bits: int = FILTER_BITS) -> DataFrame:
    """``refs_missing`` with a filter in front: rows whose reference the filter rules out are
    missing for certain and are not shuffled; only the others meet the inventory. ``sketch`` may have been
    made before, of this inventory or a larger one (``inventory_filter``, ``merge_filters``)."""
    ref_on = ref_on or on
    sketch = inventory_filter(ref, ref_on, bits) if sketch is None else sketch
    flagged = maybe_present(df, on, sketch, "_tv_maybe", bits)
    sure = flagged.where(~F.col("_tv_maybe")).drop("_tv_maybe")
    open_ = flagged.where(F.col("_tv_maybe")).drop("_tv_maybe")
    return sure.unionByName(refs_missing(open_, ref, on, ref_on))
