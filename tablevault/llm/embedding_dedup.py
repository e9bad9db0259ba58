"""Near-duplicate vectors by cosine, found with randomised-rotation binary codes.

A random rotation turns a unit vector ``x``; the signs of the turned coordinates are its
binary code, ``c = sign(Rx) / sqrt(d)``, and ``f = <c, Rx>`` the stored correction factor.
``<c, Ry> / f`` is an unbiased estimate of ``<x, y>``; its error is about
``sqrt((1 - f * f) / f / f / (d - 1))`` times the part of ``y`` across ``x``.

1. Equal vectors form one class, by the SHA-256 of their components; a class goes on
   as one row and its copies count as links.
2. Each vector gets one key in each of ``bands(d)`` bands: the largest coordinate and its sign
   under two further rotations. A pair at the threshold shares a band with ``RECALL``.
3. Rows ``(key, id, code)`` are sorted in ranges. Two codes of one bucket that differ in more
   bits than a pair at the threshold ever does (``SIGMAS`` deviations) rule each other out;
   only rows with a possible partner go on. Buckets that are cut by a range or a batch, or
   are larger than ``NEAR`` rows, go on with what was not compared: nothing is lost there.
4. In a bucket the estimates of both directions with their confidence bounds decide: pairs
   whose upper bound is below the threshold are dropped, all others are recomputed exactly
   in double precision. A pair counts in the first band it shares only. Buckets are dealt into
   blocks of ``BLOCK_ROWS`` rows, compared block by block inside tasks; what comes out is
   one count for each vector and a spanning forest of its links, never the pairs.

Components are the forests' (``components.py``). Comparing a bucket of ``m`` different vectors
costs ``m * m / 2`` estimates and ``m * m / BLOCK_ROWS`` rows sent to the blocks.

Vectors that are null, empty, zero, or hold null or non-finite components link with
nothing, nor do vectors of different lengths or rows with a null id (their component is
null). Repeated rows are copies of each other. Columns besides the id and the vector are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablevault.llm.common import free_shuffles, map_arrow, mix, written
from tablevault.llm.components import components

THRESHOLD = 0.9
RECALL = 0.995  # of pairs exactly at the threshold; of closer ones more
SIGMAS = 5.0
CODE_BITS = 128  # at least; a multiple of the length
NEAR = 64  # neighbours of a bucket's row that its code is compared with
BLOCK_ROWS = 1024
PAIRS = 1 << 16  # recomputed at once


@lru_cache(maxsize=256)
def rotation(d: int, k: int) -> np.ndarray:
    """The ``k``-th random rotation of ``d`` dimensions."""
    q, r = np.linalg.qr(np.random.default_rng([d, k]).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def n_codes(d: int) -> int:
    return -(-CODE_BITS // d)


def _corner(turned: np.ndarray) -> np.ndarray:
    """The largest coordinate by size and its sign."""
    k = np.abs(turned).argmax(axis=1)
    return (k * 2 + (turned[np.arange(len(k)), k] > 0)).astype(np.uint64)


@lru_cache(maxsize=16)
def bands(d: int) -> int:
    """Bands that find a pair at the threshold with ``RECALL``, by drawing such pairs."""
    rng = np.random.default_rng(d)
    x, z = rng.normal(size=(2, 8192, d))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if d > 1:
        z -= (z * x).sum(axis=1, keepdims=True) * x
        z *= np.sqrt(1 - THRESHOLD ** 2) / np.linalg.norm(z, axis=1, keepdims=True)
    p = 1.0 if d == 1 else float((_corner(x) == _corner(THRESHOLD * x + z)).mean())
    return max(1, int(np.ceil(np.log(1 - RECALL) / np.log(max(1e-12, 1 - p * p)))))


def band_keys(units: np.ndarray) -> np.ndarray:
    """One 64-bit key for each row and band; the length and band are part of it."""
    d = units.shape[1]
    keys = np.empty((len(units), bands(d)), np.uint64)
    for b in range(keys.shape[1]):
        first, second = (_corner(units @ rotation(d, n_codes(d) + 2 * b + k)) for k in (0, 1))
        keys[:, b] = mix(mix((first << np.uint64(32)) | second) + np.uint64((d << 32) + b))
    return keys


def codes(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Turned rows, their signs (1 and -1) and correction factors, one layer for each rotation."""
    d = units.shape[1]
    turned = np.stack([units @ rotation(d, k) for k in range(n_codes(d))])
    signs = np.where(turned > 0, 1.0, -1.0)
    return turned, signs, (signs * turned).sum(axis=2) / np.sqrt(d)


def spreads(factors: np.ndarray, d: int) -> np.ndarray:
    """The error (one deviation) of each row's estimates for pairs at the threshold."""
    spread = np.sqrt(np.maximum(1 - factors ** 2, 0) / factors ** 2 / max(d - 1, 1) / len(factors)).mean(axis=0)
    return np.sqrt(1 - THRESHOLD ** 2) * spread


def estimates(turned: np.ndarray, scaled: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Estimated inner products of all rows ``left`` with all rows ``right``, the mean over rotations
    and both directions; ``scaled`` is the code over its factor."""
    there = np.matmul(scaled[:, left], turned[:, right].transpose(0, 2, 1)).mean(axis=0)
    back = np.matmul(turned[:, left], scaled[:, right].transpose(0, 2, 1)).mean(axis=0)
    return (there + back) / 2


def pair_estimates(turned: np.ndarray, scaled: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The same of each row ``a`` with its row ``b``."""
    both = np.einsum("lij,lij->i", scaled[:, a], turned[:, b]) + np.einsum("lij,lij->i", turned[:, a], scaled[:, b])
    return both / 2 / len(turned)


def _units(column: pa.Array, d: int) -> np.ndarray:
    rows = np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), d) if len(column) else np.zeros((0, d))
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def marked(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, mark, vector)``: vectors as doubles, equal marks for equal ones, null for those that link with nothing."""
    spec = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    kind = spec.schema["id"].dataType.simpleString()

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, rows = [], []
            column = batch.column("vector")
            for k in range(batch.num_rows):
                x = column[k].values if column[k].is_valid and batch.column("id")[k].is_valid else None
                row = None
                if x is not None and len(x) and not x.null_count:
                    x = x.to_numpy() + 0.0  # minus zero becomes zero
                    row = x.tobytes() if np.isfinite(x).all() and x.any() else None
                rows.append(row)
                marks.append(row and hashlib.sha256(row).digest()[:16])
            yield pa.record_batch([batch.column("id"), pa.array(marks, pa.binary()), pa.array(rows, pa.binary())],
                                  names=["id", "mark", "vector"])

    return map_arrow(spec, mark, f"id {kind}, mark binary, vector binary")


def _by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray]]:
    size = np.array([len(x) // 8 for x in batch.column(column).to_pylist()], np.int64)
    for d in np.unique(size):
        yield int(d), np.flatnonzero(size == d)


def coded(classes: DataFrame) -> DataFrame:
    """One row ``(key, id, code)`` for each class and band."""
    kind = classes.schema["id"].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows in _by_length(batch, "vector"):
                for lo in range(0, len(rows), 2048):
                    part = batch.take(pa.array(rows[lo:lo + 2048]))
                    units = _units(part.column("vector"), d)
                    keys = band_keys(units)
                    signs = codes(units)[1].transpose(1, 0, 2).reshape(len(units), -1) > 0
                    packed = np.packbits(signs, axis=1)
                    at = pa.array(np.repeat(np.arange(len(units)), keys.shape[1]))
                    yield pa.record_batch([pa.array(keys.reshape(-1).view(np.int64)), part.column("id").take(at),
                                           pa.array([r.tobytes() for r in packed], pa.binary()).take(at)], names=["key", "id", "code"])

    return map_arrow(classes.select("id", "vector"), code, f"key long, id {kind}, code binary")


def _most_bits(bits: int) -> float:
    """Code bits in which a pair at the threshold differs at most, ``SIGMAS`` deviations up."""
    p = np.arccos(THRESHOLD) / np.pi
    return bits * p + SIGMAS * np.sqrt(bits * p * (1 - p))


def possible(rows: DataFrame) -> DataFrame:
    """The rows ``(key, id)`` that the codes of their bucket do not rule out."""
    kind = rows.schema["id"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, key = batch.num_rows, batch.column("key").to_numpy()
            if not n:
                continue
            raw = batch.column("code").to_pylist()
            width = max(map(len, raw))
            code = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in raw), np.uint8).reshape(n, width)
            most = np.array([_most_bits(8 * len(r)) for r in raw])
            # buckets that the batch may cut go on whole
            near = (key == key[0]) | (key == key[-1])
            live = np.arange(n - 1)
            for k in range(1, NEAR + 1):
                live = live[live + k < n]
                live = live[key[live] == key[live + k]]
                if not len(live):
                    break
                open_ = live[~(near[live] & near[live + k])]
                close = open_[np.bitwise_count(code[open_] ^ code[open_ + k]).sum(axis=1) <= most[open_]]
                near[close] = near[close + k] = True
            else:  # larger buckets go on whole
                near |= np.isin(key, key[live])
            yield batch.select(["key", "id"]).filter(pa.array(near))

    ranges = rows.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    return map_arrow(ranges, compare, f"key long, id {kind}")


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each of ``n`` rows reaches over links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        fresh = label.copy()
        np.minimum.at(fresh, a, low)
        np.minimum.at(fresh, b, low)
        fresh = fresh[fresh]
        if (fresh == label).all():
            return label
        label = fresh


def links_in_buckets(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``(id, links, root)``: copies linked to a class inside one block of a bucket, and the class
    that stands for what is linked there."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    dealt = rows.join(sizes, "key").withColumn("blocks", F.ceil(F.col("m") / BLOCK_ROWS).cast("int"))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", "id", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    full = classes.select("id", "n", "vector").hint("merge").join(dealt, "id")
    full = full.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "id")
    kind = classes.schema["id"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(block: pa.Table) -> Iterator[pa.RecordBatch]:
            """The links of complete blocks."""
            block = block.combine_chunks()
            for part in block.to_batches():
                yield from _links_of_blocks(part)

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            # the last block may go on in the next batch
            marks = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")])
            same = (marks == marks[:, -1:]).all(axis=0)
            cut = int(np.flatnonzero(same)[0]) if len(same) else 0
            if cut:
                yield from done(table.slice(0, cut))
                held = table.slice(cut).to_batches()
        if held:
            yield from done(pa.Table.from_batches(held))

    return map_arrow(full, compare, f"id {kind}, links long, root {kind}")


def _candidates(block: np.ndarray, turned: np.ndarray, scaled: np.ndarray, spread: np.ndarray, at: np.ndarray,
                side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one block whose upper confidence bound reaches the threshold. ``at`` is the
    row's vector; ``side`` 0 is compared with 1 alone, 2 with all others of its block."""
    n = len(block)
    size = np.bincount(block)[block]
    live = np.flatnonzero((size <= NEAR) & (side == 2))
    for k in range(1, NEAR):  # small blocks together, neighbours at distance k
        live = live[live + k < n]
        live = live[block[live] == block[live + k]]
        for lo in range(0, len(live), PAIRS):
            a = live[lo:lo + PAIRS]
            x, y = at[a], at[a + k]
            good = pair_estimates(turned, scaled, x, y) + SIGMAS * np.maximum(spread[x], spread[y]) >= THRESHOLD
            yield a[good], a[good] + k
    for g in np.unique(block[(size > NEAR) | (side != 2)]):
        rows = np.flatnonzero(block == g)
        left, right = rows[side[rows] != 1], rows[side[rows] != 0]
        bound = estimates(turned, scaled, at[left], at[right]) + SIGMAS * np.maximum(
            spread[at[left]][:, None], spread[at[right]][None, :])
        maybe = bound >= THRESHOLD
        a, b = np.nonzero(np.triu(maybe, 1) if side[rows[0]] == 2 else maybe)
        yield left[a], right[b]


def _links_of_blocks(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    if not part.num_rows:
        return
    key, i, j, mine, copies = (part.column(c).to_numpy() for c in ("key", "i", "j", "mine", "n"))
    block = np.cumsum(np.concatenate([[True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])) - 1
    side = np.where(i == j, 2, np.where(mine == i, 0, 1))
    links: list[tuple[np.ndarray, np.ndarray]] = []
    # all vectors of a bucket have one length, as it is part of the key
    length = np.array([len(x) // 8 for x in part.column("vector").to_pylist()], np.int64)
    for d in np.unique(length):
        rows = np.flatnonzero(length == d)
        # a vector stands in many buckets: it is turned once
        vectors = part.column("vector").take(pa.array(rows)).dictionary_encode()
        at, units = vectors.indices.to_numpy(), _units(vectors.dictionary, int(d))
        turned, signs, factors = codes(units)
        scaled = signs / np.sqrt(d) / factors[:, :, None]
        keys = band_keys(units).view(np.int64)
        for a, b in _candidates(block[rows], turned, scaled, spreads(factors, int(d)), at, side[rows]):
            for lo in range(0, len(a), PAIRS):
                p, q = a[lo:lo + PAIRS], b[lo:lo + PAIRS]
                x, y = at[p], at[q]
                # the first band that both share is this bucket's
                own = key[rows[p]]
                good = keys[x, (keys[x] == keys[y]).argmax(axis=1)] == own
                p, q, x, y = p[good], q[good], x[good], y[good]
                exact = np.einsum("ij,ij->i", units[x], units[y]) >= THRESHOLD
                links.append((rows[p[exact]], rows[q[exact]]))
    a, b = (np.concatenate([x[k] for x in links] or [np.zeros(0, np.int64)]) for k in (0, 1))
    counts = np.zeros(part.num_rows, np.int64)
    np.add.at(counts, a, copies[b])
    np.add.at(counts, b, copies[a])
    some = np.flatnonzero(counts)
    ids = part.column("id")
    yield pa.record_batch([ids.take(pa.array(some)), pa.array(counts[some]), ids.take(pa.array(_forest(part.num_rows, a, b)[some]))],
                          names=["id", "links", "root"])


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, n_links, class_id, component_id, kept)`` of every row: other vectors linked
    directly, the smallest id with the same vector, the smallest id reachable over links, and
    whether this row is that one."""
    free_shuffles(vectors.sparkSession)
    rows = marked(vectors, id_col, vector_col)
    classes = written(rows.where("mark is not null").groupBy("mark").agg(
        F.min("id").alias("id"), F.count("*").alias("n"), F.first("vector").alias("vector")), "classes")
    likely = written(possible(coded(classes)), "possible")
    found = written(links_in_buckets(likely, classes), "links")
    linked = found.groupBy("id").agg(F.sum("links").alias("links"))
    forest = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))

    # copies find their class by mark; only marks that repeat are looked up, salted for those of many rows
    salt = F.pmod(F.xxhash64("id"), F.lit(16)).cast("int")
    repeated = classes.where("n > 1").select("mark", F.col("id").alias("first"), "n",
                                             F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt"))
    out = rows.select("id", "mark", salt.alias("salt")).join(repeated, ["mark", "salt"], "left").select(
        "id", "mark", F.coalesce("first", "id").alias("class_id"), F.coalesce("n", F.lit(1)).alias("n"))
    attrs = classes.select(F.col("id").alias("class_id")).join(linked.withColumnRenamed("id", "class_id"), "class_id").join(
        forest.toDF("class_id", "component"), "class_id", "left")
    out = out.join(attrs, "class_id", "left")
    some = F.col("mark").isNotNull()
    return out.select(
        F.col("id").alias(id_col),
        F.when(some, F.coalesce("links", F.lit(0)) + F.col("n") - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
        "class_id", F.coalesce("component", "class_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
