"""Token ids of whole texts in entropy-coded files, in ascending id order or one given.

A file holds one frequency table and blocks of whole documents. A block holds
the documents' ids and token counts, the coder's states, checkpoints and words,
and is covered by a CRC-32; blocks decode independently of each other, and parts
of a long one from its checkpoints. A new file begins after ``FILE_TOKENS``
tokens, so a task never holds more than that (or one document).

Tasks write files of their own, under names no other attempt uses; which files
count is what the committed manifest table says, one row per block. So retried
or repeated tasks leave unused files at worst.

Null and empty texts give the end id alone. Rows that repeat an id are written
each, in the order of their texts; a null id comes first. Other columns are
ignored. An empty table gives no files and no rows.

File: ``RANSTOK1``, blocks, table. Block: length of the document list (u32), of
the checkpoints (u32), of the words (u64), the document list as an Arrow stream
(id, n_tokens), states (u64 each), checkpoints (u64), words (u32). Table: zlib of
symbols then frequencies (u32). All little-endian.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablevault.llm import rans
from tablevault.llm.common import file_system, free_shuffles, map_arrow, slices, written
from tablevault.llm.token_count import Encoder
from tablevault.session import new_work_dir

END_ID = 2
BLOCK_TOKENS = 1 << 19
FILE_TOKENS = 1 << 23
BLOCKS_PER_TASK = 8  # that a task reads
SLICE_BYTES = 4 << 20  # of text that is encoded together: its distinct units are looked up once
MAGIC = b"RANSTOK1"
HEAD = struct.Struct("<IIQ")


def _write_file(target: str, name: str, ids: list, arrays: list[np.ndarray]) -> list[dict]:
    """One file of whole documents; rows for the manifest, one per block."""
    fs, folder = file_system(target)
    path = f"{folder}/{name}"
    table = rans.Table.count(np.concatenate(arrays)) if arrays else rans.Table.count(np.zeros(0, np.int64))
    rows, lo, at, tokens = [], 0, len(MAGIC), 0
    with fs.open_output_stream(path) as out:
        out.write(MAGIC)
        while lo < len(arrays):
            hi, n = lo, 0
            while hi < len(arrays) and n < BLOCK_TOKENS:
                n += len(arrays[hi])
                hi += 1
            listing = io.BytesIO()
            docs = pa.record_batch([pa.concat_arrays(ids[lo:hi]), pa.array([len(a) for a in arrays[lo:hi]], pa.int64())],
                                   names=["id", "n_tokens"])
            with pa.ipc.new_stream(listing, docs.schema) as stream:
                stream.write_batch(docs)
            states, words, marks = rans.encode(np.concatenate(arrays[lo:hi]), table)
            block = b"".join([HEAD.pack(listing.tell(), len(marks), len(words)), listing.getvalue(),
                              states.astype("<u8").tobytes(), marks.astype("<u8").tobytes(), words.astype("<u4").tobytes()])
            out.write(block)
            rows.append({"path": f"{target}/{name}", "block": len(rows), "offset": at, "length": len(block),
                         "crc32": zlib.crc32(block), "n_docs": hi - lo, "n_tokens": n})
            at, lo, tokens = at + len(block), hi, tokens + n
        packed = zlib.compress(np.concatenate([table.symbols, table.freqs]).astype("<u4").tobytes())
        out.write(packed)
    return [r | {"table_offset": at, "table_length": len(packed), "table_crc32": zlib.crc32(packed)} for r in rows]


def write_tokens(docs: DataFrame, target: str, tokenizer: str, end_id: int | None = END_ID, id_col: str = "doc_id",
                 text_col: str = "text", order: tuple[Column, ...] | None = None) -> DataFrame:
    """Write the token files below ``target`` and return the manifest, itself
    written there: ``path``, ``part``, ``seq``, ``block``, ``offset``, ``length``, ``crc32``,
    ``n_docs``, ``n_tokens`` and the place of the file's table. ``order``: expressions
    over ``docs`` by which the documents are written instead of id and text."""
    spark = docs.sparkSession
    free_shuffles(spark)
    end = np.array([] if end_id is None else [end_id], np.uint32)
    spec = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    if order is None:
        ranges = spec.repartitionByRange("id").sortWithinPartitions("id", "text")
    else:
        keys = [f"_order{k}" for k in range(len(order))]
        spec = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
                           *(c.alias(k) for c, k in zip(order, keys)))
        ranges = spec.repartitionByRange(*keys).sortWithinPartitions(*keys).select("id", "text")
    schema = ("path string, part int, seq int, block int, offset long, length long, crc32 long, n_docs long, "
              "n_tokens long, table_offset long, table_length long, table_crc32 long")
    names = [f.strip().split(" ")[0] for f in schema.split(",")]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, attempt = Encoder.of(tokenizer), TaskContext.get().partitionId(), uuid.uuid4().hex
        fs, folder = file_system(f"{target}/files")
        fs.create_dir(folder, recursive=True)
        ids, arrays, held, seq = [], [], 0, 0

        def flush():
            rows = _write_file(f"{target}/files", f"part-{part:06d}-{seq:04d}-{attempt}.tok", ids, arrays)
            return pa.RecordBatch.from_pylist([r | {"part": part, "seq": seq} for r in rows], schema=arrow)

        for batch in batches:
            for piece in slices(batch, "text", SLICE_BYTES):
                coded, counts = encode(piece.column("text"))
                for k, ids_ in enumerate(np.split(coded, np.cumsum(counts)[:-1])):
                    ids.append(piece.column("id").slice(k, 1))
                    arrays.append(np.concatenate([ids_, end]))
                    held += len(arrays[-1])
                    if held >= FILE_TOKENS:
                        yield flush()
                        ids, arrays, held, seq = [], [], 0, seq + 1
        if arrays:
            yield flush()

    arrow = pa.schema([(n, pa.string() if n == "path" else pa.int32() if n in ("part", "seq", "block") else pa.int64())
                       for n in names])
    manifest = f"{target}/manifest"
    map_arrow(ranges, write, schema).write.parquet(manifest)
    return spark.read.schema(schema).parquet(manifest)


def read_block(row: dict, table: rans.Table | None = None) -> tuple[pa.RecordBatch, np.ndarray]:
    """The document list and all token ids of a block, checked against its CRC."""
    fs, path = file_system(row["path"])
    with fs.open_input_file(path) as f:
        table = table or read_table(f, row)
        block = f.read_at(row["length"], row["offset"])
    if zlib.crc32(block) != row["crc32"]:
        raise ValueError(f"{row['path']}: block {row['block']} is damaged")
    n_list, n_marks, n_words = HEAD.unpack_from(block)
    at = HEAD.size
    docs = pa.ipc.open_stream(block[at:at + n_list]).read_next_batch()
    at += n_list
    states = np.frombuffer(block, "<u8", rans.LANES, at).astype(np.uint64)
    at += rans.LANES * 8
    marks = np.frombuffer(block, "<u8", n_marks * (rans.LANES + 2), at).reshape(n_marks, rans.LANES + 2).astype(np.uint64)
    words = np.frombuffer(block, "<u4", n_words, at + n_marks * (rans.LANES + 2) * 8)
    # stretches between checkpoints are independent; each is decoded from its own
    starts = [(0, 0, states), *((int(m[0]), int(m[1]), m[2:]) for m in marks)]
    ends = [s[0] for s in starts[1:]] + [None]
    parts = [rans.decode(row["n_tokens"], table, x, words, step, word, end) for (step, word, x), end in zip(starts, ends)]
    return docs, np.concatenate(parts)


def read_table(f, row: dict) -> rans.Table:
    packed = f.read_at(row["table_length"], row["table_offset"])
    if zlib.crc32(packed) != row["table_crc32"]:
        raise ValueError(f"{row['path']}: the table is damaged")
    both = np.frombuffer(zlib.decompress(packed), "<u4")
    return rans.Table(both[:len(both) // 2].astype(np.int64), both[len(both) // 2:].astype(np.int64))


def read_tokens(manifest: DataFrame, id_type: str = "bigint", with_ids: bool = True) -> DataFrame:
    """``(id, start, n_tokens, ids_crc32[, ids])`` of every document, decoded from the
    files; ``start`` counts the ids of all documents before it."""
    order = W.partitionBy(F.lit(0)).orderBy("part", "seq").rowsBetween(W.unboundedPreceding, -1)
    files = manifest.groupBy("part", "seq").agg(F.sum("n_tokens").alias("n")).withColumn(
        "base", F.coalesce(F.sum("n").over(order), F.lit(0))).drop("n")
    inside = W.partitionBy("part", "seq").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(files, ["part", "seq"])
    blocks = written(blocks.withColumn("start", F.col("base") + F.col("before")).drop("base", "before"), "blocks")
    n = max(1, min(-(-blocks.count() // BLOCKS_PER_TASK), 1 << 15))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, table = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["path"] != path:
                    path, table = row["path"], None
                    fs, place = file_system(path)
                    with fs.open_input_file(place) as f:
                        table = read_table(f, row)
                docs, ids = read_block(row, table)
                counts = docs.column("n_tokens").to_numpy()
                ends = np.cumsum(counts)
                sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip((ends - counts).tolist(), ends.tolist())]
                columns = [docs.column("id"), pa.array(ends - counts + row["start"]), docs.column("n_tokens"),
                           pa.array(sums, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids.astype(np.int64))))
                yield pa.record_batch(columns, names=["id", "start", "n_tokens", "ids_crc32", "ids"][:len(columns)])

    return map_arrow(blocks.repartition(n), read, f"id {id_type}, start long, n_tokens long, ids_crc32 long"
                     + (", ids array<long>" if with_ids else ""))


def with_id_starts(read: DataFrame) -> DataFrame:
    """``read_tokens`` rows with ``start`` renamed to ``place``, and ``start`` the number
    of ids of all documents before it in id order, those of one id by place."""
    rows = written(read.withColumnRenamed("start", "place").repartitionByRange("id").withColumn(
        "_part", F.spark_partition_id()), "places")
    ahead = W.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = rows.groupBy("_part").agg(F.sum("n_tokens").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    inside = W.partitionBy("_part").orderBy("id", "place").rowsBetween(W.unboundedPreceding, -1)
    before = rows.withColumn("_before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return before.join(parts, "_part").select("id", (F.col("_ahead") + F.col("_before")).alias("start"), "n_tokens",
                                              "ids_crc32", "place")


def tokens_written_and_read(docs: DataFrame, tokenizer: str, end_id: int | None = END_ID, id_col: str = "doc_id",
                            text_col: str = "text", order: tuple[Column, ...] | None = None) -> DataFrame:
    """Write the files to a new folder below the shared one, and what they hold. With
    an ``order`` of their own ``place`` is where a document stands in the files, and
    ``start`` where it would stand in id order."""
    target = new_work_dir(docs.sparkSession, "tokens")
    manifest = write_tokens(docs, target, tokenizer, end_id, id_col, text_col, order)
    read = read_tokens(manifest, docs.schema[id_col].dataType.simpleString(), with_ids=False)
    return (read if order is None else with_id_starts(read)).withColumnRenamed("id", id_col)


