"""Benchmark decontamination with suffix arrays over the training text.

A task builds a suffix array over the words of each shard (a slice of its rows
of bounded size) and binary-searches every suffix of every benchmark item in
it. Suffixes that share their first ``window`` words with an item's suffix give
all places of that window (``find_matches``); the neighbours of a suffix's own place in the
order say how many words its longest verbatim match has at least, and all suffixes that
share these are measured, so the longest match is found (``longest_matches``, combined
across shards).

Documents are not shuffled. The benchmark is the query set. Its distinct items are written to the
shared folder as blocks of about ``block_bytes``, and a task that searches its shards opens one
block after the other and lets it go again: neither the driver nor a task holds more
than one block (or one item that is larger), however large the benchmark is.

Null and empty texts have no words and no hits. An item without words never
occurs; an item of fewer words than a window is one window. Items with the
same id count once, a null id is the empty string. Repeated rows are each
judged. Columns besides the id and the text are kept out of the work.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablevault.llm.common import LOWER, file_system, flat_text, map_arrow, slices, span_hashes, word_spans, written
from tablevault.session import new_work_dir

WINDOW = 10
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 4 << 20
DEPTH = 16  # words by which suffixes are ordered; longer matches are read off the text
CANDIDATES = 1 << 20  # places of longest matches measured at once

# Word bytes after lower-casing: digits, letters and all of non-ASCII.
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows, and the row of each."""
    data, offsets = flat_text(column)
    data = LOWER[data]
    starts, ends, rows = word_spans(IS_WORD[data], offsets)
    return span_hashes(data, starts, ends), rows


class SuffixArray:
    """Suffixes of a sequence of words, ordered by their first ``depth`` words.

    ``words`` are hashes, ``rows`` the (ascending) row of each. A separator that
    is smaller than all words stands after each row, so no match crosses rows.
    """

    def __init__(self, words: np.ndarray, rows: np.ndarray, depth: int = DEPTH):
        codes, distinct = pd.factorize(words)
        order = np.argsort(distinct)
        self.distinct = distinct[order]
        rank = np.empty(len(distinct), np.int64)
        rank[order] = np.arange(1, len(distinct) + 1)
        new_row = np.flatnonzero(np.diff(rows)) + 1
        self.ids = np.zeros(len(words) + len(new_row) + 1, np.int64)
        self.at = np.arange(len(words)) + np.searchsorted(new_row, np.arange(len(words)), side="right")
        self.ids[self.at] = rank[codes]
        self.order = self._sorted(depth)

    def _sorted(self, depth: int) -> np.ndarray:
        """Prefix doubling: ranks by one word, then by 2, 4, ... words."""
        rank, n = self.ids, len(self.ids)
        bits = max(1, int(n).bit_length())
        order, width = None, 1
        while order is None or width < depth:
            after = np.zeros(n, np.int64)
            after[:max(0, n - width)] = rank[width:]
            key = (rank.astype(np.uint64) << np.uint64(bits)) | after.astype(np.uint64)
            if 3 * bits <= 64:  # key and position in one integer
                key = np.sort((key << np.uint64(bits)) | np.arange(n, dtype=np.uint64))
                order = (key & np.uint64((1 << bits) - 1)).astype(np.int64)
                key >>= np.uint64(bits)
            else:
                order = np.argsort(key, kind="stable")
                key = key[order]
            fresh = np.empty(n, np.int64)
            fresh[0] = 0
            np.cumsum(key[1:] != key[:-1], out=fresh[1:])
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            width *= 2
            if fresh[-1] == n - 1:
                break
        return order

    def ids_of(self, words: np.ndarray) -> np.ndarray:
        """Ids of words, -1 for those that do not occur here."""
        at = np.searchsorted(self.distinct, words)
        at[at == len(self.distinct)] = 0
        return np.where(self.distinct[at] == words, at + 1, -1)

    def bound(self, query: np.ndarray, lengths: np.ndarray, right: bool) -> np.ndarray:
        """Number of suffixes before each query (a row of ids, ``lengths`` of them
        count), or before the first suffix that does not start with it (``right``)."""
        n, width = len(self.order), query.shape[1]
        lo, hi = np.zeros(len(query), np.int64), np.full(len(query), n, np.int64)
        column = np.arange(width)
        counts = column[None, :] < lengths[:, None]
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            there = self.ids[np.minimum(self.order[mid][:, None] + column, n - 1)]
            differ = (there != query[open_]) & counts[open_]
            first = differ.argmax(axis=1)
            some = np.arange(len(open_))
            any_ = differ[some, first]
            less = np.where(any_, there[some, first] < query[open_][some, first], right)
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)

    def common(self, suffix: np.ndarray, words: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Words that the suffixes at ``suffix`` share with ``words[at:ends]``."""
        length = np.zeros(len(suffix), np.int64)
        live = np.arange(len(suffix))
        while len(live):
            i, j = suffix[live] + length[live], at[live] + length[live]
            ok = (j < ends[live]) & (i < len(self.ids))
            ok[ok] = self.ids[i[ok]] == words[j[ok]]
            live = live[ok]
            length[live] += 1
        return length


class Queries:
    """The windows and suffixes of a block of benchmark items."""

    def __init__(self, names: pa.Array, texts: pa.Array, window: int):
        self.names = names.to_pylist()
        self.window = window
        self.words, rows = word_hashes(texts)
        self.marks = np.array([zlib.crc32(t) for t in texts.cast(pa.binary()).to_pylist()], np.int64)
        n = np.bincount(rows, minlength=len(names)) if len(rows) else np.zeros(len(names), np.int64)
        ends = np.cumsum(n)
        self.end = ends[rows] if len(rows) else rows
        left = self.end - np.arange(len(rows))
        whole = n[rows] if len(rows) else rows
        # suffixes that start a window: a whole one, or all of a short item
        keep = (left >= window) | (left == whole)
        self.at, self.item = np.flatnonzero(keep), rows[keep]
        self.size = np.minimum(left[keep], window)
        self.first = (ends - n)[self.item]  # the item's first word


class Shard:
    """The suffix array of some rows."""

    def __init__(self, column: pa.Array, depth: int):
        self.words, self.rows = word_hashes(column)
        self.n_words = (np.bincount(self.rows, minlength=len(column)).astype(np.int64) if len(self.rows)
                        else np.zeros(len(column), np.int64))
        self.begin = np.cumsum(self.n_words) - self.n_words
        self.array = SuffixArray(self.words, self.rows, depth) if len(self.words) else None
        if self.array:
            self.back = np.zeros(len(self.array.ids), np.int64)  # word number of a place in the array
            self.back[self.array.at] = np.arange(len(self.words))

    def occurring(self, q: Queries, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the windows that occur here, and their range in the order."""
        column = np.arange(q.window)
        grid = ids[np.minimum(q.at[:, None] + column, max(0, len(ids) - 1))]
        inside = column[None, :] < q.size[:, None]
        maybe = np.flatnonzero(((grid > 0) | ~inside).all(axis=1))
        lo = self.array.bound(grid[maybe], q.size[maybe], False)
        hi = self.array.bound(grid[maybe], q.size[maybe], True)
        return maybe[lo < hi], lo[lo < hi], hi[lo < hi]


class Found(NamedTuple):
    """The windows of a block of queries that occur in a shard."""

    queries: Queries
    suffix: np.ndarray   # numbers of the windows that occur
    same: np.ndarray     # the group of equal windows of each
    place: np.ndarray    # word at which a window occurs
    group: np.ndarray    # its group
    size: np.ndarray     # words of the windows of a group


def windows_in(shard: Shard, q: Queries) -> Found | None:
    """All places of a block's windows in a shard."""
    if not shard.array or not len(q.at):
        return None
    maybe, lo, hi = shard.occurring(q, shard.array.ids_of(q.words))
    if not len(maybe):
        return None
    # equal windows of several items have the same places
    _, one, same = np.unique(lo * np.int64(q.window + 1) + q.size[maybe], return_index=True, return_inverse=True)
    many = hi[one] - lo[one]
    place = shard.array.order[np.repeat(lo[one], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
    return Found(q, maybe, same, shard.back[place], np.repeat(np.arange(len(one)), many), q.size[maybe][one])


def longest_in(shard: Shard, q: Queries) -> tuple[np.ndarray, ...]:
    """Suffix, row, word and length of the longest matches of a block's suffixes in a shard: for each row
    that has it, the first place."""
    none = (np.zeros(0, np.int64),) * 4
    if not shard.array or not len(q.at):
        return none
    array, ids = shard.array, shard.array.ids_of(q.words)
    found, lo, hi = shard.occurring(q, ids)
    if not len(found):
        return none
    at, ends = q.at[found], q.end[q.at[found]]
    deep = ids[np.minimum(at[:, None] + np.arange(DEPTH), len(ids) - 1)]
    seat = array.bound(deep, np.minimum(ends - at, DEPTH), False)
    least = np.zeros(len(at), np.int64)
    for side in (seat - 1, seat):  # beside its own place in the order
        side = np.clip(side, 0, len(array.order) - 1)
        least = np.maximum(least, array.common(array.order[side], ids, at, ends))
    # the order tells no more than DEPTH words apart: all that share as many are measured
    least = np.minimum(least, DEPTH)
    lo, hi = array.bound(deep, least, False), array.bound(deep, least, True)
    total = np.cumsum(hi - lo)
    longest = np.zeros(len(at), np.int64)
    best: list[tuple[np.ndarray, ...]] = []
    k = 0
    while k < len(at):  # some suffixes at a time, and of one with many places some places at a time
        to = max(k + 1, int(np.searchsorted(total, (total[k - 1] if k else 0) + CANDIDATES, side="right")))
        many = hi[k:to] - lo[k:to]
        for skip in range(0, int(many.sum()), CANDIDATES):
            number = np.arange(skip, min(skip + CANDIDATES, int(many.sum())))
            of = np.searchsorted(np.cumsum(many), number, side="right") + k
            place = array.order[number - (np.cumsum(many) - many)[of - k] + lo[of]]
            length = array.common(place, ids, at[of], ends[of])
            np.maximum.at(longest, of, length)
            top = length == longest[of]
            word, of, length = shard.back[place[top]], of[top], length[top]
            row = shard.rows[word]
            order = np.lexsort((word, row, of))  # of the places in one row the first
            word, of, length, row = word[order], of[order], length[order], row[order]
            first = np.ones(len(of), bool)
            first[1:] = (of[1:] != of[:-1]) | (row[1:] != row[:-1])
            best.append((of[first], row[first], word[first], length[first]))
        k = to
    of, row, word, length = (np.concatenate(x) for x in zip(*best))
    keep = length == longest[of]
    return found[of[keep]], row[keep], word[keep], length[keep]


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> list[str]:
    """Write the distinct items as blocks to the shared folder; their files. Only names of files pass
    through the driver."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("name"),
                             F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).distinct()
    items = written(items, "items")
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-2 * total // block_bytes))  # half full on average, as hashes deal unevenly
    folder = new_work_dir(spark, "item-blocks")
    items.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(blocks))).repartition("block").write.option(
        "compression", "zstd").partitionBy("block").parquet(folder)
    listed = spark.read.schema(items.schema).parquet(folder).select(F.col("_metadata.file_path").alias("path")).distinct()
    return sorted(r["path"] for r in listed.collect())


def read_block(path: str, window: int) -> Queries:
    fs, place = file_system(unquote(path))
    rows = pq.read_table(place, columns=["name", "text"], filesystem=fs).combine_chunks()
    return Queries(rows.column("name").combine_chunks(), rows.column("text").combine_chunks(), window)


class Blocks:
    """The blocks of a benchmark in a task, one at a time."""

    def __init__(self, paths: list[str], window: int):
        self.paths, self.window, self.held = paths, window, (None, None)

    def __iter__(self) -> Iterator[Queries]:
        for path in self.paths:
            if self.held[0] != path:
                self.held = (None, None)  # the one before goes first
                self.held = (path, read_block(path, self.window))
            yield self.held[1]


def find_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: ``id_col``, ``n_words``, ``n_hit`` (words inside an
    occurrence of a window), ``spans`` (maximal runs of hit words, as start and
    number of words) and ``items`` (sorted ids of items with a window in it)."""
    paths = item_blocks(benchmark, item_col, item_text_col, block_bytes)
    spec = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = (f"id {spec.schema['id'].dataType.simpleString()}, n_words long, n_hit long, "
              "spans array<struct<start:long,n_words:long>>, items array<string>")
    span_t = pa.list_(pa.struct([("start", pa.int64()), ("n_words", pa.int64())]))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(paths, window)
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES):
                shard = Shard(part.column("text"), max(DEPTH, window))
                n, n_words = part.num_rows, shard.n_words
                cover = np.zeros(int(n_words.sum()) + 1, np.int64)
                names: list[set[str]] = [set() for _ in range(n)]
                for q in blocks:
                    found = windows_in(shard, q)
                    if found is None:
                        continue
                    np.add.at(cover, found.place, 1)
                    np.add.at(cover, found.place + found.size[found.group], -1)
                    of_group: list[set[str]] = [set() for _ in range(len(found.size))]
                    for g, item in set(zip(found.same.tolist(), q.item[found.suffix].tolist())):
                        of_group[g].add(q.names[item])
                    for row, g in {*zip(shard.rows[found.place].tolist(), found.group.tolist())}:
                        names[row] |= of_group[g]
                hit = np.cumsum(cover)[:-1] > 0
                starts, ends, rows_ = word_spans(hit, np.append(shard.begin, n_words.sum()))
                spans: list[list[dict]] = [[] for _ in range(n)]
                for a, b, row in zip(starts.tolist(), ends.tolist(), rows_.tolist()):
                    spans[row].append({"start": a - int(shard.begin[row]), "n_words": b - a})
                n_hit = np.bincount(rows_, ends - starts, minlength=n).astype(np.int64) if len(rows_) else np.zeros(n, np.int64)
                yield pa.record_batch([
                    part.column("id"), pa.array(n_words), pa.array(n_hit), pa.array(spans, span_t),
                    pa.array([sorted(x) for x in names], pa.list_(pa.string()))],
                    names=["id", "n_words", "n_hit", "spans", "items"])

    return map_arrow(spec, match, schema).withColumnRenamed("id", id_col)


def longest_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text", least: int = WINDOW,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The longest verbatim match of every suffix of every item in all documents: ``item_id``,
    ``item_word`` (where the suffix begins), ``id_col``, ``word`` and ``n_words``, one row for each suffix
    and document that has it (there the first place). Suffixes whose longest match has fewer than
    ``least`` words are left out, but for a whole item that is shorter.

    Each shard gives its longest matches; a partial maximum for each suffix drops the shorter
    ones. Items with one id and different texts are told apart by a hash of the text."""
    paths = item_blocks(benchmark, item_col, item_text_col, block_bytes)
    spec = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(paths, least)
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES):
                shard = Shard(part.column("text"), max(DEPTH, least))
                for q in blocks:
                    suffix, row, word, length = longest_in(shard, q)
                    item = q.item[suffix]
                    yield pa.record_batch([
                        pa.array(q.names, pa.string()).take(pa.array(item)), pa.array(q.marks[item]),
                        pa.array(q.at[suffix] - q.first[suffix]), part.column("id").take(pa.array(row)),
                        pa.array(word - shard.begin[row]), pa.array(length)],
                        names=["item_id", "item_mark", "item_word", "id", "word", "n_words"])

    found = written(map_arrow(spec, match, "item_id string, item_mark long, item_word long, "
                              f"id {spec.schema['id'].dataType.simpleString()}, word long, n_words long"), "longest")
    key = ["item_id", "item_mark", "item_word"]
    top = found.groupBy(*key).agg(F.max("n_words").alias("n_words"))
    return found.join(top, [*key, "n_words"]).groupBy(*key, "id").agg(
        F.min("word").alias("word"), F.first("n_words").alias("n_words")).drop("item_mark").withColumnRenamed("id", id_col)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                        item_text_col: str = "text", window: int = WINDOW,
                        block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows whose text holds no window of the benchmark, all columns as they were."""
    paths = item_blocks(benchmark, item_col, item_text_col, block_bytes)
    # plain names inside, as names with dots cannot be handed to Python
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    text = plain.columns[docs.columns.index(text_col)]

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(paths, window)
        for batch in batches:
            for part in slices(batch, text, SHARD_BYTES):
                shard, keep = Shard(part.column(text), max(DEPTH, window)), np.ones(part.num_rows, bool)
                for q in blocks:
                    found = windows_in(shard, q)
                    if found is not None:
                        keep[shard.rows[found.place]] = False
                yield part.filter(pa.array(keep))

    return map_arrow(plain, clean, plain.schema).toDF(*docs.columns)


def items_digest(items) -> str:
    """SHA-256 of item ids, comma-joined."""
    return hashlib.sha256(",".join(items).encode()).hexdigest()
