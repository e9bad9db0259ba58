"""Near-duplicate documents by SetSketch registers.

Each distinct shingle set gets ``REGISTERS`` registers: every shingle throws
exponentially distributed values at registers, a register keeps the smallest,
rounded to a power of ``BASE``. Registers of a union are the register-wise
extremes, so sketches of parts can be merged.

1. Documents with equal sets form one class; its smallest id stands for it.
2. Bands of ``BAND_ROWS`` registers are hashed. In each bucket every class is
   paired with the bucket's smallest one, never all with all.
3. The joint likelihood of the registers and the set sizes estimates the overlap;
   pairs far below the threshold are dropped, the others confirmed on full sets.
4. Confirmed links give components. Those that share a bucket with a component's
   centres but are not in it are compared with all others that do, block by block
   inside the tasks: the registers first name the classes that may be linked across
   components, then these alone bring their full sets, are confirmed in the blocks, and
   a spanning forest of their links comes out, never the pairs.

A text without words or null has no shingles and links with nothing; fewer words
than a shingle make one shingle of all of them. Repeated rows are copies of each
other. Rows with a null id link with nothing and have a null class and component. Columns
besides the id and the text are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablevault.llm.common import (LOWER, flat_text, free_shuffles, map_arrow, mix, slices, span_hashes, word_spans,
                                   written)
from tablevault.llm.components import components

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 75
BAND_ROWS, BANDS = 5, 48  # a pair at the threshold shares a band with 1 - 2e-6
REGISTERS = BAND_ROWS * BANDS
BASE, RATE, LIMIT = 1.15, 20.0, 255  # register values: floor(1 - log_BASE(x)), x with this rate, in one byte
SLACK = 0.13  # four and a half standard deviations of the estimate at the threshold
LEFT_BLOCK, RIGHT_BLOCK = 256, 4096  # classes of a group that are compared at once
BLOCK_SHINGLES = 1 << 21  # and shingles, but for one class that has more

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


def shingles(column: pa.Array, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, sorted by row and hash, and their rows."""
    data, offsets = flat_text(column)
    data = LOWER[data]
    starts, ends, rows = word_spans(IS_WORD[data], offsets)
    words = span_hashes(data, starts, ends)
    n = len(words)
    counts = np.bincount(rows, minlength=len(column)) if n else np.zeros(len(column), np.int64)
    total = np.zeros(max(0, n - size + 1), np.uint64)
    for k in range(size):
        total += words[k:n - size + 1 + k] * np.uint64((0x9E3779B97F4A7C15 * (2 * k + 3)) & (2**64 - 1) | 1)
    whole = rows[:len(total)] == rows[size - 1:] if n >= size else np.zeros(0, bool)
    values, owner = mix(total[whole]), rows[:len(total)][whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        ends_ = np.cumsum(counts)
        extra = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            have = counts[short] > k
            extra[have] += words[(ends_ - counts)[short][have] + k] * np.uint64((0xC2B2AE3D27D4EB4F * (2 * k + 5)) & (2**64 - 1) | 1)
        values = np.concatenate([values, mix(extra + counts[short].astype(np.uint64))])
        owner = np.concatenate([owner, short])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[first], owner[first]


def sketches(values: np.ndarray, owner: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Registers of every row with shingles (others 0), one row each.

    A shingle's values are the arrivals of a Poisson process with rate
    ``REGISTERS * RATE``, each at a register drawn at random, so each register
    sees independent exponential values. Only arrivals below a limit are drawn
    at which nearly all registers are full; rows with an empty one go again
    with twice the limit."""
    smallest = np.full((len(sizes), REGISTERS), np.inf)
    todo, factor = np.flatnonzero(sizes), np.log(REGISTERS) + 4
    while len(todo):
        limit = np.zeros(len(sizes))
        limit[todo] = factor / (sizes[todo] * RATE)
        live = limit[owner] > 0
        v, o = values[live], owner[live]
        x, k = np.zeros(len(v)), 0
        while len(v):
            z = mix(v + np.uint64((0x9E3779B97F4A7C15 * (k + 1)) & (2**64 - 1)))
            x = x - np.log((((z >> np.uint64(12)).astype(np.float64)) + 0.5) / 2.0**52) / (REGISTERS * RATE)
            low = x <= limit[o]
            v, o, x, z = v[low], o[low], x[low], z[low]
            slot = ((z & np.uint64(0xFFF)) * np.uint64(REGISTERS) >> np.uint64(12)).astype(np.int64)
            np.minimum.at(smallest.reshape(-1), o * REGISTERS + slot, x)
            k += 1
        todo = todo[~np.isfinite(smallest[todo]).all(axis=1)]
        smallest[todo] = np.inf
        factor *= 2
    out = np.zeros(smallest.shape, np.uint8)
    full = sizes > 0
    out[full] = np.clip(np.floor(1 - np.log(smallest[full]) / np.log(BASE)), 0, LIMIT)
    return out


def likely_overlap(u: np.ndarray, v: np.ndarray, n_u: np.ndarray, n_v: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of pairs, from the numbers of registers in
    which either side is larger and the sizes of the sets."""
    more, less = (u > v).sum(axis=1)[:, None], (u < v).sum(axis=1)[:, None]
    a, b = (n_u / (n_u + n_v))[:, None], (n_v / (n_u + n_v))[:, None]
    most = np.minimum(n_u / n_v, n_v / n_u)[:, None]
    j = most * np.linspace(0, 1, 201)[None, :]

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = p(a - b * j), p(b - a * j)
    tiny = 1e-12
    gain = more * np.log(up + tiny) + less * np.log(down + tiny) \
        + (u.shape[1] - more - less) * np.log(np.maximum(1 - up - down, tiny))
    return np.take_along_axis(j, gain.argmax(axis=1)[:, None], axis=1)[:, 0]


def quick_overlap(more: np.ndarray, less: np.ndarray, n_u: float, n_v: np.ndarray) -> np.ndarray:
    """The estimate in closed form, for a base near 1: the likelihood's derivative is
    then a quadratic. Coarser bases make it a little larger, never much smaller."""
    a, b = n_u / (n_u + n_v), n_v / (n_u + n_v)
    same = REGISTERS - more - less
    p, q, r = a * b * REGISTERS, same * (a * a + b * b) + b * b * more + a * a * less, same * a * b
    return (q - np.sqrt(np.maximum(q * q - 4 * p * r, 0))) / (2 * p)


def sketch_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, n_shingles, set_a, set_b, registers)``; set_a and set_b are equal for
    equal sets."""
    spec = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = spec.schema["id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, owner = shingles(part.column("text"))
                n = np.bincount(owner, minlength=part.num_rows).astype(np.int64) if len(owner) else np.zeros(part.num_rows, np.int64)
                regs = sketches(values, owner, n)
                marks = []
                for salt in (0x1234567, 0x89ABCDE):
                    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(values ^ np.uint64(salt)), dtype=np.uint64)])
                    ends = np.cumsum(n)
                    marks.append((sums[ends] - sums[ends - n]).view(np.int64))
                yield pa.record_batch([part.column("id"), pa.array(n), pa.array(marks[0]), pa.array(marks[1]),
                                       pa.array([r.tobytes() for r in regs], pa.binary())],
                                      names=["id", "n_shingles", "set_a", "set_b", "registers"])

    return map_arrow(spec, sketch, f"id {kind}, n_shingles long, set_a long, set_b long, registers binary")


def band_keys(classes: DataFrame) -> DataFrame:
    """One row per class and band: ``(id, key)``."""
    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                regs = _matrix(part.column("registers")).astype(np.uint64).reshape(part.num_rows, BANDS, BAND_ROWS)
                keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), regs.shape[:2]).copy()
                for k in range(BAND_ROWS):
                    keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + regs[:, :, k])
                ids = part.column("id").take(pa.array(np.repeat(np.arange(part.num_rows), BANDS)))
                yield pa.record_batch([ids, pa.array(keys.reshape(-1).view(np.int64))], names=["id", "key"])

    kind = classes.schema["id"].dataType.simpleString()
    return map_arrow(classes.select("id", "registers"), bands, f"id {kind}, key long")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), REGISTERS)


def likely_pairs(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose estimated similarity is not far below the threshold."""
    side = classes.select("id", "n_shingles", "registers")
    # neither side is broadcast: pairs grow with the documents
    both = side.toDF("a", "n_a", "regs_a").hint("merge").join(pairs, "a")
    both = side.toDF("b", "n_b", "regs_b").hint("merge").join(both, "b")
    kind = classes.schema["id"].dataType.simpleString()

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                n_a, n_b = (part.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("n_a", "n_b"))
                guess = likely_overlap(_matrix(part.column("regs_a")), _matrix(part.column("regs_b")), n_a, n_b)
                yield part.select(["a", "b"]).filter(pa.array(guess >= THRESHOLD_PERCENT / 100 - SLACK))

    return map_arrow(both, keep, f"a {kind}, b {kind}")


def groups_across(members: DataFrame, found: DataFrame) -> DataFrame:
    """``(centre, id, part, left)``: the classes that share a bucket with a centre in the component
    ``centre``, once for each such component, not for each centre or bucket. ``left`` marks those that
    lie in another component themselves."""
    parts = found.toDF("id", "part")
    rows = members.join(parts.toDF("centre", "main"), "centre", "left").select(
        F.coalesce("main", "centre").alias("centre"), "id").distinct()
    rows = rows.join(parts, "id", "left").withColumn("part", F.coalesce("part", "id"))
    return written(rows.withColumn("left", F.col("part") != F.col("centre")), "parts")


def dealt(rows: DataFrame, sides: DataFrame) -> DataFrame:
    """``rows`` of ``groups_across`` with the columns of ``sides`` (by id), dealt into blocks
    ``(centre, i, j)``: ``i`` of the classes on the left, ``j`` of all, each of a bounded number of
    classes, and of shingles if ``sides`` has their sets, so a group is spread over tasks however
    large it is."""
    weigh = "members" in sides.columns
    if weigh:
        rows = rows.join(sides.select("id", "n_shingles"), "id")

    def blocks(some, rows_: int):
        need = F.sum(F.when(some, 1).otherwise(0)) / rows_
        if weigh:
            need = F.greatest(need, F.sum(F.when(some, F.col("n_shingles")).otherwise(0)) / BLOCK_SHINGLES)
        return F.ceil(need).cast("int")

    sizes = rows.groupBy("centre").agg(blocks(F.col("left"), LEFT_BLOCK).alias("i_n"), blocks(F.lit(True), RIGHT_BLOCK).alias("j_n"),
                                       F.count("*").alias("n")).where("i_n > 0 and n > 1").drop("n")
    rows = sides.hint("merge").join(rows.drop("n_shingles").join(sizes, "centre"), "id")

    def deal(count: str, salt: int):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.col(count)).cast("int")

    def places(side: int, count: str, place):
        at = F.transform(F.sequence(F.lit(0), F.col(count) - 1), place)
        return at if side else F.when(F.col("left"), at).otherwise(F.array().cast(at_type))

    at_type = "array<struct<side:int,i:int,j:int>>"
    mine_i, mine_j = deal("i_n", 1), deal("j_n", 2)
    at = F.concat(places(0, "j_n", lambda k: F.named_struct(F.lit("side"), F.lit(0), F.lit("i"), mine_i, F.lit("j"), k)),
                  places(1, "i_n", lambda k: F.named_struct(F.lit("side"), F.lit(1), F.lit("i"), k, F.lit("j"), mine_j)))
    keep = ["centre", "id", "part", *[c for c in sides.columns if c != "id"]]
    blocks_ = rows.select(*keep, F.explode(at).alias("at")).select(*keep, "at.side", "at.i", "at.j")
    return blocks_.repartition("centre", "i", "j").sortWithinPartitions("centre", "i", "j", "side")


def by_block(batches: Iterator[pa.RecordBatch], work) -> Iterator[pa.RecordBatch]:
    """What ``work(left, right)`` yields for every block of sorted, dealt rows."""
    group, sides = None, ([], [])

    def done() -> Iterator[pa.RecordBatch]:
        if all(sides):
            yield from work(*(pa.Table.from_batches(x).combine_chunks().to_batches()[0] for x in sides))

    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("centre", "i", "j", "side"))))
        cuts = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            if keys and lo < hi:
                if keys[lo][:3] != group:
                    yield from done()
                    group, sides = keys[lo][:3], ([], [])
                sides[keys[lo][3]].append(batch.slice(lo, hi - lo))
    yield from done()


class Block:
    """The classes on the left and on the right of one block, with numbers for their components."""

    def __init__(self, left: pa.RecordBatch, right: pa.RecordBatch):
        self.left, self.right = left, right
        both = pa.chunked_array([left.column("part"), right.column("part")]).combine_chunks()
        part = both.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        self.part_l, self.part_r = part[:left.num_rows].copy(), part[left.num_rows:].copy()
        self.regs_l, self.regs_r = _matrix(left.column("registers")), _matrix(right.column("registers"))
        self.n_l, self.n_r = (x.column("n_shingles").to_numpy().astype(float) for x in (left, right))

    def likely(self, k: int) -> np.ndarray:
        """Classes on the right, of other components, that the registers say may be linked with the ``k``-th on the left."""
        n, floor = self.n_l[k], THRESHOLD_PERCENT / 100 - SLACK
        fits = np.flatnonzero((self.part_r != self.part_l[k]) & (
            np.minimum(n, self.n_r) * 100 >= np.maximum(n, self.n_r) * THRESHOLD_PERCENT))
        own, far = self.regs_l[k], self.regs_r[fits]
        guess = quick_overlap((own > far).sum(axis=1), (own < far).sum(axis=1), n, self.n_r[fits])
        fits = fits[guess >= floor - 0.02]
        if not len(fits):
            return fits
        guess = likely_overlap(np.broadcast_to(own, (len(fits), REGISTERS)), self.regs_r[fits], np.full(len(fits), n), self.n_r[fits])
        return fits[guess >= floor]


def likely_across(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``(centre, id)`` of the classes in ``rows`` that may be linked across components."""
    kind = classes.schema["id"].dataType.simpleString()

    def flag(left: pa.RecordBatch, right: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        block = Block(left, right)
        near_l, near_r = np.zeros(left.num_rows, bool), np.zeros(right.num_rows, bool)
        for k in range(left.num_rows):
            fits = block.likely(k)
            near_l[k] = len(fits) > 0
            near_r[fits] = True
        for side, near in ((left, near_l), (right, near_r)):
            yield side.select(["centre", "id"]).filter(pa.array(near))

    blocks = dealt(rows, classes.select("id", "n_shingles", "registers"))
    return map_arrow(blocks, lambda batches: by_block(batches, flag), f"centre {kind}, id {kind}").distinct()


def links_across(rows: DataFrame, sides: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between components, confirmed on full sets inside the blocks. As soon as a
    link joins two components of a block they count as one there, so a block gives a
    spanning forest, fewer links than it has classes, and not all linked pairs."""
    kind = sides.schema["id"].dataType.simpleString()

    def link(left: pa.RecordBatch, right: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        block = Block(left, right)
        sets_l, sets_r = left.column("members"), right.column("members")
        flat = np.concatenate([sets_l.flatten().to_numpy(), sets_r.flatten().to_numpy()])
        distinct, local = np.unique(flat, return_inverse=True)
        local_l, local_r = local[:len(sets_l.flatten())], local[len(sets_l.flatten()):]
        ends_l, ends_r = (np.cumsum(np.concatenate([[0], pc.list_value_length(x).to_numpy()])) for x in (sets_l, sets_r))
        own, pairs = np.zeros(len(distinct), bool), []
        for k in range(left.num_rows):
            fits = block.likely(k)
            if not len(fits):
                continue
            mine = local_l[ends_l[k]:ends_l[k + 1]]
            own[mine] = True
            both = np.array([np.count_nonzero(own[local_r[ends_r[f]:ends_r[f + 1]]]) for f in fits])
            own[mine] = False
            fits = fits[both * 100 >= (block.n_l[k] + block.n_r[fits] - both) * THRESHOLD_PERCENT]
            for part, at in zip(*np.unique(block.part_r[fits], return_index=True)):
                pairs.append((k, fits[at]))
                for parts in (block.part_l, block.part_r):
                    parts[parts == part] = block.part_l[k]
        if pairs:
            a, b = zip(*pairs)
            yield pa.record_batch([left.column("id").take(pa.array(a)), right.column("id").take(pa.array(b))], names=["a", "b"])

    return map_arrow(dealt(rows, sides), lambda batches: by_block(batches, link), f"a {kind}, b {kind}").distinct()


def full_sets(wanted: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, members)``: the shingles of the documents whose ``id`` is in ``wanted``, written once."""
    spec = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = spec.schema["id"].dataType.simpleString()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                values, owner = shingles(part.column("text"))
                offsets = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.record_batch([part.column("id"), pa.ListArray.from_arrays(
                    pa.array(offsets), pa.array(values.view(np.int64)))], names=["id", "members"])

    return written(map_arrow(spec.hint("merge").join(wanted.distinct(), "id", "left_semi"), build,
                             f"id {kind}, members array<long>"), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets overlap enough."""
    common = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    union = F.size("set_a").cast("long") + F.size("set_b") - common
    both = sets.toDF("b", "set_b").hint("merge").join(sets.toDF("a", "set_a").hint("merge").join(pairs, "a"), "b")
    return both.where(common * 100 >= union * THRESHOLD_PERCENT).select("a", "b").distinct()


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their component, columns as they were;
    of rows that repeat an id all stay or none."""
    gone = near_duplicates(docs, id_col, text_col).where(~F.col("kept") & F.col(id_col).isNotNull())
    return docs.join(gone.select(F.col(id_col).alias("_tv_gone")).distinct(), F.col(id_col) == F.col("_tv_gone"), "left_anti")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_shingles, class_id, component_id, kept)`` of every row: the smallest
    id with the same set, the smallest id reachable over links, and whether this
    row is that one."""
    free_shuffles(docs.sparkSession)
    sketched = written(sketch_table(docs, id_col, text_col), "sketches")
    sets = sketched.where("n_shingles > 0 and id is not null")
    mark = ["n_shingles", "set_a", "set_b"]
    # equal sets have equal registers
    classes = written(sets.groupBy(*mark).agg(F.min("id").alias("id"), F.first("registers").alias("registers")), "classes")
    named = classes.select(*mark, F.col("id").alias("class_id"))

    keys = written(band_keys(classes), "bands")
    centres = keys.groupBy("key").agg(F.min("id").alias("centre"), F.count("*").alias("n")).where("n > 1")
    # only buckets of several classes go on
    shared = written(keys.join(centres.drop("n"), "key").select("key", "id", "centre"), "buckets")
    star = written(likely_pairs(shared.where("id <> centre").select(F.col("id").alias("a"), F.col("centre").alias("b"))
                                .distinct(), classes), "star")
    both_ends = star.select(F.col("a").alias("id")).unionAll(star.select(F.col("b").alias("id")))
    links = written(confirmed(star, full_sets(both_ends, docs, id_col, text_col)), "links")

    # what shares a bucket with a component and lies outside is compared with all others that do
    members = shared.select("id", "centre").unionAll(shared.select(F.col("centre").alias("id"), "centre")).distinct()
    rows = groups_across(members, components(links))
    near = written(likely_across(rows, classes), "across")
    sets = full_sets(near.select("id"), docs, id_col, text_col)
    sets = sets.withColumn("n_shingles", F.size("members").cast("long")).dropDuplicates(["id", "n_shingles"])
    sides = classes.select("id", "n_shingles", "registers").join(sets, ["id", "n_shingles"])
    more = written(links_across(rows.join(near, ["centre", "id"], "left_semi"), sides), "links")
    found = components(links.unionAll(more))

    ids = sketched.join(named, mark, "left").join(found.toDF("class_id", "component"), "class_id", "left")
    ids = ids.withColumn("class_id", F.when(F.col("id").isNotNull(), F.col("class_id")))
    own = F.when(F.col("n_shingles") > 0, F.coalesce("component", "class_id", "id")).otherwise(F.col("id"))
    own = F.when(F.col("id").isNotNull(), own)
    return ids.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("class_id", "id").alias("class_id"),
                      own.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
