"""The prefix trie of conversations, by ROLLUP over positional columns of turn ids.

A turn's id is the first half of the SHA-256 of its role and text, followed by the
number of code points of the text; the texts themselves are never shuffled.

1. Conversations are cut into blocks of ``BLOCK`` turns, one row each: the node that
   the block before ends at, and one column for each turn id. A node's name is the hash
   of the name of its block's first node and the turn ids from there, so the rows of all
   blocks are made in one pass over the sorted turns.
2. ``GROUP BY block, node, ROLLUP (t1, ..)`` counts all prefixes of all blocks together;
   ``grouping_id`` tells how many columns a group has, so how deep its node lies. Groups
   whose last column is past a conversation's end are no nodes.
3. Every node is named by its smallest member. A conversation is the smallest member
   from some depth on down to its end, so what those nodes save is one sum for each
   conversation, and whether its last node is a leaf one flag. A second ROLLUP adds
   both over the members of each node: subtree sums without walking the tree. The nodes
   of the smallest member itself above the node are taken out again by a running sum.

Hot nodes (the root, an opening that a third of all conversations share) are added up
before they are shuffled; lookups of a parent by its children are salted. Lists of
members are hashed as a stream: sorted ranges make chunks of text, and a node's chunks
are hashed one after another, so no task holds a list.

A null role or text counts as empty. Turns are ordered by number, null first, those
of equal number by turn id; repeated rows are further turns. Rows with a null id are
left out. Columns besides the named ones are ignored; an empty table gives no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablevault.llm.common import map_arrow, written

BLOCK = 8  # turns in a row of the rollup
NAME_BYTES = 16  # of a turn's or node's hash
SALTS = 16  # tasks that look up one parent
CHUNK_CHARS = 1 << 16  # of a list of members
TURNS = [f"t{k}" for k in range(1, BLOCK + 1)]


def _name(*parts: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 2 * NAME_BYTES))


def turn_ids(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, pos, tid)``: the turns of each conversation in order, from 1."""
    role_, text_ = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    # the length in front keeps a role's end apart from a text's start
    tid = F.concat(_name(F.encode(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_), "utf-8")),
                   F.unhex(F.lpad(F.hex(F.length(text_).cast("long")), 8, "0")))
    spec = turns.select(F.col(f"`{conv}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), tid.alias("tid"))
    # the window streams over its sorted rows, however many one conversation has
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "tid")
    return spec.where("conv_id is not null").select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "tid")


def shared_openings(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with shared openings, as ``(all conversations, their turns)``:
    the first ``crc32(id) % most`` turns come from conversation ``id - id % every``, the
    others are its own from there on."""
    turns = written(turns, "turns")
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n")).select(
        "conv_id", "n", (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"))
    bases = convs.where("conv_id = base").select("base", F.col("n").alias("base_n"))
    convs = written(convs.join(bases, "base", "left").withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0)))), "convs")
    # at most ``every`` conversations to each side of zero share a base, and a base lends a few turns
    lent = turns.where((F.col("pos") < most) & (F.col("conv_id") % every == 0)).withColumnRenamed("conv_id", "base")
    heads = convs.join(lent, "base").where("pos <= head").select("conv_id", "pos", "tid")
    own = turns.join(convs.select("conv_id", "h", "head"), "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), "tid")
    return convs.select("conv_id"), heads.unionByName(own)


def blocks(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row for each block of a conversation: ``(conv_id, block, node, t1, .., ending)``;
    ``ending``, in its last block alone, is the node where it ends. A conversation without
    turns has one block without turns."""
    rows = turns.select("conv_id", "pos", "tid").unionByName(
        convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("tid")))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    schema = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("node", pa.binary()),
                        *((t, pa.binary()) for t in TURNS), ("ending", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in schema]
        conv, block, node, held = None, 0, b"", []

        def put(last: bool) -> bytes:
            name = hashlib.sha256(node + b"".join(held)).digest()[:NAME_BYTES] if held else node
            for column, value in zip(out, [conv, block, node, *held, *[None] * (BLOCK - len(held)), name if last else None]):
                column.append(value)
            return name

        for batch in batches:
            for c, pos, tid in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if pos == 0:  # a conversation's first row
                    if conv is not None:
                        put(True)
                    conv, block, node, held = c, 0, b"", []
                    continue
                if len(held) == BLOCK:
                    node, block, held = put(False), block + 1, []
                held.append(tid)
            yield pa.record_batch([pa.array(column, f.type) for column, f in zip(out, schema)], schema=schema)
            out = [[] for _ in schema]
        if conv is not None:
            put(True)
            yield pa.record_batch([pa.array(column, f.type) for column, f in zip(out, schema)], schema=schema)

    return map_arrow(rows, cut, "conv_id long, block long, node binary, " + ", ".join(f"{t} binary" for t in TURNS)
                     + ", ending binary")


def rolled_up(rows: DataFrame, aggregates: str) -> DataFrame:
    """Aggregates of every prefix: ``(key, parent, depth, tid, ..)``, the root without turns."""
    cols = ", ".join(TURNS)
    found = rows.sparkSession.sql(
        f"""select block, node, {cols}, {BLOCK} - bit_count(grouping_id()) as d, {aggregates}
            from {{rows}} group by block, node, rollup ({cols})""", rows=rows)
    last = F.get(F.array(*TURNS), F.col("d") - 1)
    # a group without columns repeats the node before, but for the root
    found = found.withColumn("tid", last).where("case when d = 0 then block = 0 else tid is not null end")

    def prefix(upto: Column) -> Column:
        parts = [F.when(F.lit(k + 1) <= upto, F.col(t)).otherwise(F.expr("X''")) for k, t in enumerate(TURNS)]
        return F.when(upto <= 0, F.col("node")).otherwise(_name(F.col("node"), *parts))

    return found.withColumns({"key": prefix(F.col("d")), "depth": F.col("block") * BLOCK + F.col("d"),
                              "parent": F.when(F.col("d") > 0, prefix(F.col("d") - 1))}).drop("block", "node", "d", *TURNS)


def list_hashes(members: DataFrame) -> DataFrame:
    """``(key, sha256)`` of the comma-joined ``conv_id`` of each ``key`` in ascending order."""
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, parts, size = None, 0, [], 0
        out: list[tuple] = []
        for batch in batches:
            for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if parts and (k != key or size >= CHUNK_CHARS):
                    out.append((key, first, ",".join(parts)))
                    parts, size = [], 0
                if not parts:
                    key, first = k, c
                parts.append(str(c))
                size += len(parts[-1]) + 1
            if out:
                yield pa.record_batch([pa.array(x) for x in zip(*out)], names=["key", "first", "ids"])
                out = []
        if parts:
            yield pa.record_batch([[key], [first], [",".join(parts)]], names=["key", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if k == key:
                    state.update(b",")
                else:
                    if state:
                        out.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield pa.record_batch([pa.array(x) for x in zip(*out)], names=["key", "sha256"])
        if state:
            yield pa.record_batch([[key], [state.hexdigest()]], names=["key", "sha256"])

    # ranges of (key, id) split a hot node's members over tasks
    rows = members.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    texts = map_arrow(rows, chunks, "key binary, first long, ids string")
    return map_arrow(texts.repartition("key").sortWithinPartitions("key", "first"), hashed, "key binary, sha256 string")


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the trie of ``turns`` ``(conv_id, pos, tid)`` over all ``convs``:
    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    cut = written(blocks(convs, turns), "blocks")
    nodes = written(rolled_up(cut, "count(*) as n_convs, min(conv_id) as conv_id"), "prefixes")
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))

    chars = F.conv(F.hex(F.substring("tid", NAME_BYTES + 1, 4)), 16, 10).cast("long")
    path = Window.partitionBy("conv_id")  # the nodes that a conversation names
    down = path.orderBy("depth")
    up = path.orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    nodes = nodes.join(children, "key", "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0)),
        "saved": F.coalesce((F.col("n_convs") - 1) * chars, F.lit(0))})
    nodes = written(nodes.withColumns({
        "total": F.sum("saved").over(path), "below": F.sum("saved").over(up),
        "first": F.row_number().over(down) == 1}).drop("tid", "saved"), "nodes")

    # of the nodes a conversation names at most the last one is a leaf
    named = nodes.groupBy("conv_id").agg(F.max(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaf"),
                                         F.first("total").alias("total"))
    sums = rolled_up(cut.drop("ending").join(named, "conv_id"), "sum(leaf) as n_leaves, sum(total) as saved_all").select(
        "key", "n_leaves", "saved_all")

    # only the first node that a conversation names has a parent of another name
    branch = nodes.where("first and depth > 0").select("key", "parent", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int").alias("salt"))
    above = nodes.join(branch.select(F.col("parent").alias("key")).distinct(), "key", "left_semi").select(
        F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    above = branch.join(above, ["parent", "salt"]).select("key", "parent_conv")

    ends = list_hashes(cut.where("ending is not null").select(F.col("ending").alias("key"), "conv_id"))
    return (nodes.join(sums, "key").join(above, "key", "left").join(ends, "key", "left").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent_conv", "conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", (F.col("saved_all") - F.col("total") + F.col("below")).alias("saved_tokens"),
        F.coalesce("sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256")))
