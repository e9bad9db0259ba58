"""Periodic runs of words inside a text, by an online sparse diagonal DP.

For word ``i`` and an earlier occurrence ``i - p`` of it the diagonal of lag ``p``
has a match at ``i``; a diagonal's match length grows while words keep matching,
and when it ends, ``match + p`` words of period ``p`` are a run if they are long
enough. Keeping every earlier occurrence would cost the square of a word's count,
so the table of diagonals is kept sparse without losing a run: a run of period
``p`` and at least ``3 * p`` (and 24) words matches at ``max(2 * p, 16)`` or more
consecutive words, hence at a position that is a multiple of the largest power of
two up to that. Lags from ``2**m`` to ``2**(m + 1)`` are opened only at multiples of
``2**(m + 1)``: half a comparison for each word and power, whatever the text.

1. The earlier occurrences of the words at those places are found for all texts of
   a slice at once; openings without 16 matches around them are dropped.
2. The rest are taken in the order of the words. An opening whose diagonal is active,
   or whose lag is a multiple of an active lag inside the same stretch, adds nothing.
   Otherwise its match length is advanced, many words at a time, until it ends.
3. Diagonals that end long enough emit their run; of lags with one stretch the
   smallest is its period.

Words are compared as bytes, never by hash. Time is in proportion to the words times
the logarithm of the longest text, also for one word repeated throughout; a
task holds one slice of texts, or one longer text, as a list of words.

A null or empty text has no words, no runs and an empty collapsed text. Repeated rows
and null ids are judged row by row. Columns besides the id and the text are ignored
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablevault.llm.common import map_arrow, slices

LEAST_WORDS = 24  # words of a run at least
LEAST_POWER = 3  # periods of a run at least
SURE = 16  # matches in a row that every run has: min over p of max(2 p, 24 - p)

Run = tuple[int, int, int]  # start, length, period


def openings(words: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags at which diagonals must be looked at: earlier occurrences of the
    words at the places of each power of two."""
    places, lags = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    size, first, last = SURE, 1, SURE - 1  # block size, and the columns that hold its lags
    while size == SURE or (size // 2) * LEAST_POWER <= longest:
        padded = np.concatenate([words, np.full(-len(words) % size, -1, np.int64)]).reshape(-1, size)
        block, column = np.nonzero(padded[:-1, first:last + 1] == padded[1:, :1])
        places.append((block + 1) * size)
        lags.append(size - first - column)
        size, last = size * 2, size
    return np.concatenate(places), np.concatenate(lags)


def with_matches_around(words: np.ndarray, places: np.ndarray, lags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The openings whose diagonal matches at ``SURE`` words in a row or more."""
    have = np.ones(len(places), np.int64)
    for sign in (1, -1):
        live = np.flatnonzero(have < SURE)
        for step in range(1, SURE):
            at = places[live] + sign * step
            inside = (at < len(words)) & (at >= lags[live])
            live, at = live[inside], at[inside]
            live = live[words[at] == words[at - lags[live]]]
            if not len(live):
                break
            have[live] += 1
    return places[have >= SURE], lags[have >= SURE]


def matches(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading entries agree."""
    done, step, n = 0, 64, min(len(a), len(b))
    while done < n:
        upto = min(done + step, n)
        differ = np.flatnonzero(a[done:upto] != b[done:upto])
        if len(differ):
            return done + int(differ[0])
        done = upto
        step *= 2
    return n


def runs_of(words: np.ndarray, longest: int) -> list[Run]:
    """Runs in one array of word numbers, sorted by start and period."""
    places, lags = with_matches_around(words, *openings(words, longest))
    order = np.lexsort((lags, places))
    places, lags = places[order], lags[order]
    wanted = np.ones(len(places), bool)
    active: dict[int, int] = {}  # lag -> where its diagonal ends
    found: dict[tuple[int, int], int] = {}
    for k in range(len(places)):
        if not wanted[k]:
            continue
        i, p = int(places[k]), int(lags[k])
        if active.get(p, -1) > i:
            continue
        end = i + matches(words[i:], words[i - p:len(words) - p])
        start = i - matches(words[p:i][::-1], words[:i - p][::-1])
        active[p] = end
        stretch = start - p
        # openings of multiples of this lag inside the stretch belong to the same run
        upto = int(np.searchsorted(places, end))
        inside = (lags[k + 1:upto] % p == 0) & (places[k + 1:upto] - lags[k + 1:upto] >= stretch)
        wanted[k + 1:upto][inside] = False
        length = end - stretch
        if length >= max(LEAST_WORDS, LEAST_POWER * p):
            found[stretch, length] = min(p, found.get((stretch, length), p))
        if len(active) > 1024:
            active = {lag: far for lag, far in active.items() if far > i}
    return sorted((s, n, p) for (s, n), p in found.items())


def _judged(texts: list[bytes | None]) -> tuple[list[int], list[list[Run]], list[bytes]]:
    """Word counts, runs and collapsed texts of a slice."""
    split = [(t or b"").split() for t in texts]  # bytes split at the six ASCII blanks
    counts = [len(w) for w in split]
    numbers: dict[bytes, int] = {}
    flat = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in split for w in ws), np.int64, sum(counts))
    # words of different texts never match
    flat += np.repeat(np.arange(len(split), dtype=np.int64) << 32, counts)
    ends = np.cumsum(counts, dtype=np.int64)
    runs: list[list[Run]] = [[] for _ in split]
    if max(counts, default=0) >= LEAST_WORDS:
        for start, length, period in runs_of(flat, max(counts)):
            row = int(np.searchsorted(ends, start, side="right"))
            runs[row].append((start - int(ends[row]) + counts[row], length, period))
    kept = []
    for words, found in zip(split, runs):
        if found:
            stays = np.ones(len(words), bool)
            for start, length, period in found:
                stays[start + period:start + length] = False
            words = [words[k] for k in np.flatnonzero(stays)]
        kept.append(b" ".join(words))
    return counts, runs, kept


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, runs, collapsed)`` of every row: its runs ``(start, length, period)``
    in words by start and period, and its text without the words that a run repeats
    after its first period."""
    spec = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                counts, runs, kept = _judged(part.column("text").cast(pa.large_binary()).to_pylist())
                runs = [[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs]
                yield pa.record_batch([part.column("id"), pa.array(counts, pa.int64()), pa.array(runs, run),
                                       pa.array(kept, pa.binary()).cast(pa.string())],
                                      names=["id", "n_words", "runs", "collapsed"])

    kind = spec.schema["id"].dataType.simpleString()
    return map_arrow(spec, judge, f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, "
                                  "collapsed string").withColumnRenamed("id", id_col)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period, of equal ones that with the
    smallest start, then period; null without runs."""
    def order(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        return (F.when(left > right, -1).when(left < right, 1)
                .when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
                .when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))

    return F.get(F.array_sort(runs, order), 0)


def runs_text(runs: Column) -> Column:
    """One line ``start,length,period`` for each run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
