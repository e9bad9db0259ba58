"""WARC archives written from and read into rows of chunks.

A payload is cut into rows ``(record, chunk number, bytes)`` of at most
``CHUNK_BYTES`` in the task that reads it, and travels as these: what is shuffled, sorted,
handed to Python, compressed and read back is chunks in order, and digests are carried along
chunk by chunk. A payload is whole only in the row that the scan gives and its hash, which
marks the record.

A record whose payload equals that of a record with a smaller page id, and has
at least ``MIN_REVISIT`` bytes, becomes a revisit of it without a body. Tasks write
archives under names no other attempt uses; the committed manifest table says
which of them count. Every record is a gzip member of its own.

Ids are percent-encoded in headers, so any character can stand in one. Null payloads are empty, null urls ``about:blank``; a null page id is kept as null
and revisits like any other, but is revisited only if all equal ones are null.
Rows that repeat a page id with the same payload are all responses if they are
the first. Other columns are ignored. An empty table gives no archives and no rows.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablevault.llm.common import file_system, free_shuffles, map_arrow, written
from tablevault.session import new_work_dir

CHUNK_BYTES = 64 << 10
FILE_BYTES = 256 << 20  # of compressed records, after which a new archive begins
MIN_REVISIT = 100
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 3
PAGE_ID, REFERS_TO_PAGE_ID = "X-Page-ID", "X-Refers-To-Page-ID"


def as_chunks(df: DataFrame, payload: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per chunk of the binary column ``payload``, in order within its
    record; an empty payload is one empty chunk. Adds ``chunk_no`` and ``data``."""
    rest = [c for c in df.columns if c != payload]
    count = F.greatest(F.lit(1), F.ceil(F.octet_length(payload) / chunk_bytes)).cast("int")
    return df.select(*rest, payload, F.explode(F.sequence(F.lit(0), count - 1)).alias("chunk_no")).select(
        *rest, "chunk_no", F.substring(payload, F.col("chunk_no") * chunk_bytes + 1, chunk_bytes).alias("data"))


def chunk_digests(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` with ``payload_bytes`` and ``payload_digest`` of every record, from its
    chunks in order (a record begins at chunk 0)."""
    spec = chunks.select(*keys, "chunk_no", "data")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sha, size = None, None, 0  # the record that may go on in the next batch
        for batch in batches:
            head, sizes, sums = [], [], []
            for k, (no, data) in enumerate(zip(batch.column("chunk_no").to_pylist(), batch.column("data"))):
                if no == 0:
                    if sha is not None:
                        sizes.append(size)
                        sums.append(sha.hexdigest())
                    head.append(k)
                    sha, size = hashlib.sha256(), 0
                data = data.as_buffer()
                sha.update(data)
                size += data.size
            firsts = pa.Table.from_batches([batch.select(keys).take(pa.array(head, pa.int64()))])
            open_ = firsts if held is None else pa.concat_tables([held, firsts])
            yield from _joined(open_.slice(0, len(sums)), sizes, sums)
            held = open_.slice(len(sums))
        if sha is not None:
            yield from _joined(held, [size], [sha.hexdigest()])

    def _joined(part: pa.Table, sizes: list[int], sums: list[str]) -> list[pa.RecordBatch]:
        whole = part.append_column("payload_bytes", pa.array(sizes, pa.int64())).append_column(
            "payload_digest", pa.array(sums, pa.string()))
        return whole.combine_chunks().to_batches()

    kinds = ", ".join(f"`{k}` {spec.schema[k].dataType.simpleString()}" for k in keys)
    return map_arrow(spec, digest, f"{kinds}, payload_bytes long, payload_digest string")


def _record_id(page: object, mark: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{mark}')}>"


def _head(row: dict) -> tuple[bytes, bytes]:
    """WARC header and HTTP head of a record."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {row['payload_bytes']}\r\n\r\n").encode()
    revisit = row["record_type"] == "revisit"
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"] or "about:blank")
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {_record_id(row['page_id'], row['mark'])}",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
             "Content-Type: application/http;msgtype=response",
             f"Content-Length: {len(http) + (0 if revisit else row['payload_bytes'])}"]
    if row["page_id"] is not None:
        lines.append(f"{PAGE_ID}: {quote(str(row['page_id']), safe='')}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(row['refers_to'], row['mark'])}",
                  f"{REFERS_TO_PAGE_ID}: {quote(str(row['refers_to']), safe='')}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode(), http


def write_archives(pages: DataFrame, target: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html") -> DataFrame:
    """Write the records of ``pages`` below ``target``; returns the manifest (``path``,
    ``part``, ``seq``, ``n_records``, ``n_bytes``), written there too."""
    free_shuffles(pages.sparkSession)
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    # a row's own number keeps the chunks of rows that repeat a page apart
    rows = pages.select(F.col(id_col).alias("page_id"), F.xxhash64(payload).alias("mark"), F.monotonically_increasing_id().alias("copy"),
                        F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    chunks = as_chunks(rows, "payload")
    sums = written(chunk_digests(chunks, ["page_id", "mark"]), "digests")
    firsts = sums.where(F.col("payload_bytes") >= MIN_REVISIT).groupBy("payload_digest").agg(
        F.min("page_id").alias("first")).where("first is not null")
    plan = sums.join(firsts, "payload_digest", "left").withColumn(
        "refers_to", F.when((F.col("payload_bytes") >= MIN_REVISIT) & ~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")))
    plan = plan.select("page_id", "mark", "payload_bytes", "payload_digest",
                       F.when(F.col("refers_to").isNull(), "response").otherwise("revisit").alias("record_type"),
                       "refers_to").distinct()
    # only chunks are shuffled, never a payload; the plan's row of a record is sorted before its chunks
    head = chunks.withColumn("url", F.when(F.col("chunk_no") == 0, F.col("url")))
    both = head.unionByName(plan.withColumn("copy", F.lit(-1).cast("long")), allowMissingColumns=True)
    chunks = both.repartition("page_id", "mark").sortWithinPartitions("page_id", "mark", "copy", "chunk_no")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        fs, folder = file_system(f"{target}/archives")
        fs.create_dir(folder, recursive=True)
        out, name, seq, records, size, pack = None, "", 0, 0, 0, None
        done = []

        def put(data: bytes) -> int:
            out.write(data)
            return len(data)

        def close() -> dict:
            out.close()
            return {"path": f"{target}/archives/{name}", "part": part, "seq": seq, "n_records": records, "n_bytes": size}

        plan = None
        for batch in batches:
            data = batch.column("data")
            for k, row in enumerate(batch.drop_columns(["data"]).to_pylist()):
                if row["chunk_no"] is None:
                    plan = row
                    continue
                if row["chunk_no"] == 0:
                    if pack is not None:
                        size += put(pack.compress(b"\r\n\r\n") + pack.flush())
                        pack = None
                    if out is not None and size >= FILE_BYTES:
                        done.append(close())
                        out, seq, records, size = None, seq + 1, 0, 0
                    if out is None:
                        name = f"part-{part:06d}-{seq:04d}-{attempt}.warc.gz"
                        out = fs.open_output_stream(f"{folder}/{name}", compression=None)
                    pack, records = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), records + 1
                    warc, http = _head(plan | {"url": row["url"]})
                    size += put(pack.compress(warc + http))
                if plan["record_type"] == "response":  # a revisit has no body
                    size += put(pack.compress(data[k].as_buffer()))
        if pack is not None:
            size += put(pack.compress(b"\r\n\r\n") + pack.flush())
            done.append(close())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=arrow)

    arrow = pa.schema([("path", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("n_records", pa.int64()),
                       ("n_bytes", pa.int64())])
    schema = "path string, part int, seq int, n_records long, n_bytes long"
    map_arrow(chunks, write, schema).write.parquet(f"{target}/manifest")
    return pages.sparkSession.read.schema(schema).parquet(f"{target}/manifest")


class _Members:
    """Reads the gzip members of an archive piece by piece."""

    def __init__(self, stream):
        self.stream, self.rest, self.text = stream, b"", b""
        self.pack = None

    def more(self) -> bool:
        """Add to ``text``; False at the end of the archive."""
        while True:
            if not self.rest:
                self.rest = self.stream.read(CHUNK_BYTES)
                if not self.rest:
                    return False
            if self.pack is None:
                self.pack = zlib.decompressobj(31)
            got = self.pack.decompress(self.rest, CHUNK_BYTES)
            self.rest = self.pack.unconsumed_tail
            if self.pack.eof:
                self.rest, self.pack = self.pack.unused_data, None
            if got:
                self.text += got
                return True

    def head(self) -> dict[str, str] | None:
        """The header fields up to an empty line, None at the end."""
        while b"\r\n\r\n" not in self.text:
            if not self.more():
                return None
        lines, self.text = self.text.split(b"\r\n\r\n", 1)
        first, *fields = lines.decode().split("\r\n")
        return {"": first} | dict(f.split(": ", 1) for f in fields)

    def take(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes in pieces."""
        while n:
            if not self.text and not self.more():
                raise ValueError("the archive ends inside a record")
            piece, self.text = self.text[:n], self.text[n:]
            n -= len(piece)
            yield piece


def read_chunks(manifest: DataFrame, with_data: bool = True, id_type: str = "bigint") -> DataFrame:
    """Rows of the archives: one per chunk of a payload with its ``page_id``,
    ``chunk_no`` and ``data``, and after the last one (``chunk_no`` null) the record's
    ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to``, checked
    against the payload. Without ``with_data`` only the latter."""
    n = max(1, min(manifest.count(), 1 << 15))
    to_id = int if id_type in ("bigint", "int", "smallint", "tinyint") else unquote

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, place = file_system(path)
                with fs.open_input_stream(place, compression=None) as stream:
                    members = _Members(stream)
                    while (fields := members.head()) is not None:
                        http = members.head()
                        page = to_id(fields[PAGE_ID]) if PAGE_ID in fields else None
                        revisit = fields["WARC-Type"] == "revisit"
                        size, said = int(http["Content-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        if not revisit:
                            sha = hashlib.sha256()
                            for k, piece in enumerate(members.take(size)):
                                sha.update(piece)
                                if with_data:
                                    rows.append({"page_id": page, "chunk_no": k, "data": piece})
                                    held += len(piece)
                                    if held >= 16 * CHUNK_BYTES:
                                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                                        rows, held = [], 0
                            if sha.hexdigest() != said:
                                raise ValueError(f"{path}: payload of page {page} does not match its digest")
                        b"".join(members.take(4))  # the blank lines after a record
                        rows.append({"page_id": page, "payload_bytes": size, "payload_digest": said,
                                     "record_type": fields["WARC-Type"],
                                     "refers_to": to_id(fields[REFERS_TO_PAGE_ID]) if revisit else None})
                        if len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    own = pa.int64() if to_id is int else pa.string()
    arrow = pa.schema([("page_id", own), ("chunk_no", pa.int32()), ("data", pa.binary()), ("payload_bytes", pa.int64()),
                       ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", own)])
    spark_id = "long" if to_id is int else "string"
    return map_arrow(manifest.select("path").repartition(n), read,
                     f"page_id {spark_id}, chunk_no int, data binary, payload_bytes long, payload_digest string, "
                     f"record_type string, refers_to {spark_id}")


def written_and_read(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write the archives to a new folder below the shared one, and the records they hold."""
    manifest = write_archives(pages, new_work_dir(pages.sparkSession, "warc"), id_col, url_col, payload_col)
    kind = pages.schema[id_col].dataType.simpleString()
    rows = read_chunks(manifest, with_data=False, id_type=kind).drop("chunk_no", "data")
    return rows.withColumnRenamed("page_id", id_col)
