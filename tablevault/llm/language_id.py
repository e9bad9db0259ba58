"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes a blank. N-grams of two and
three characters fall into ``BUCKETS`` buckets; a language's model is the log
probability of each bucket. The matrix (buckets by languages, a few MB) is sent to
all tasks, which score whole texts slice by slice with array sums.

All languages count as equally likely before a text is read (their shares in the
training rows, which are cut at a bound anyway, are no prior). The matrix is bounded by
``MAX_LANGUAGES``; more distinct labels raise an error rather than grow what is broadcast.

The model is fitted on at most ``TRAIN_ROWS`` labelled rows of each language, those
with the smallest hash of their id. Prediction reads the text only.

Null texts and texts without a letter are ``und`` with score 0, as is everything
where no language was learned. Equal scores go to the first language by name.
Rows without a label, or with a null id, are not trained on. Repeated rows are
each judged; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablevault.llm.common import map_arrow, slices

BUCKETS = 1 << 16
SIZES = (2, 3)
TRAIN_ROWS = 2000
MAX_LANGUAGES = 512  # 128 MB of log probabilities
SMOOTHING = 0.1
_FACTORS = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by a 0; where each text begins; and
    whether it has a letter."""
    texts = pc.fill_null(column, "").to_pylist()
    points = np.frombuffer("".join(t.replace("\0", " ").lower() + "\0" for t in texts).encode("utf-32-le"), np.uint32)
    starts = np.concatenate([[0], np.flatnonzero(points == 0)[:-1] + 1]).astype(np.int64)
    letter = _letters()[points]
    has = np.logical_or.reduceat(letter, starts)
    return np.where(letter, points, np.where(points == 0, 0, 32)), starts, has


def _buckets(points: np.ndarray, size: int) -> np.ndarray:
    """Bucket of the n-gram that begins at each place; ``BUCKETS`` where it would
    leave the text or holds nothing but blanks."""
    n = len(points)
    total = np.zeros(n, np.uint64)
    bad, blank = np.zeros(n, bool), np.ones(n, bool)
    for k in range(size):
        part = np.zeros(n, np.uint32)
        part[:n - k] = points[k:]
        total += part.astype(np.uint64) * _FACTORS[k]
        bad |= part == 0
        blank &= part == 32
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9 + 2 * size)
    out = (total >> np.uint64(48)).astype(np.int64)
    out[bad | blank] = BUCKETS
    return out


def held_out(id_col: str) -> Column:
    """Rows kept out of training: a third, by the CRC-32 of the id as text."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages, and their log probabilities by bucket (one extra row of zeros)."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    found = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = {r["lang"]: r["count"] for r in found}
    names = sorted(counts)
    if not names:
        return [], np.zeros((BUCKETS + 1, 0), np.float32)
    # a little over the bound by hash, then exactly
    share = F.create_map(*(F.lit(x) for n in names for x in (n, min(1.0, 1.2 * max_rows / counts[n] + 200 / counts[n]))))
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    some = rows.withColumn("_draw", draw).where(F.col("_draw") < share[F.col("lang")])
    few = some.withColumn("_rank", F.row_number().over(W.partitionBy("lang").orderBy("_draw", "id"))).where(
        F.col("_rank") <= max_rows).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                points, starts, _ = _code_points(part.column("text"))
                lang = part.column("lang").dictionary_encode()
                of = np.repeat(lang.indices.to_numpy(), np.diff(np.append(starts, len(points)))).astype(np.int64)
                both = np.concatenate([of * (BUCKETS + 1) + _buckets(points, s) for s in SIZES])
                key, n = np.unique(both, return_counts=True)
                keep = key % (BUCKETS + 1) < BUCKETS
                key, n = key[keep], n[keep]
                yield pa.record_batch([lang.dictionary.take(pa.array(key // (BUCKETS + 1))),
                                       pa.array((key % (BUCKETS + 1)).astype(np.int32)), pa.array(n.astype(np.int64))],
                                      names=["lang", "bucket", "n"])

    sums = map_arrow(few, count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = sums.toPandas()  # at most BUCKETS rows per language
    table = np.zeros((BUCKETS + 1, len(names)))
    table[found["bucket"].to_numpy(), found["lang"].map({n: k for k, n in enumerate(names)}).to_numpy(dtype=np.int64)] = found["n"]
    table = np.log((table + SMOOTHING) / (table[:BUCKETS].sum(axis=0) + SMOOTHING * BUCKETS))
    table[BUCKETS] = 0
    return names, table.astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id",
            text_col: str = "text", carry: tuple[Column, ...] = ()) -> DataFrame:
    """``(id, lang_pred, score)`` of every row, and the columns to ``carry``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    spec = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *carry)
    rest = [c for c in spec.columns if c != "text"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, table = sent.value
        columns = [np.ascontiguousarray(table[:, k]) for k in range(len(names))]
        for batch in batches:
            for part in slices(batch, "text"):
                points, starts, has = _code_points(part.column("text"))
                logs = np.zeros((part.num_rows, len(names)))
                for size in SIZES:
                    at = _buckets(points, size)
                    for k, column in enumerate(columns):
                        logs[:, k] += np.add.reduceat(column[at], starts, dtype=np.float64)
                if names:
                    best = logs.argmax(axis=1)
                    score = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
                    pred = [names[b] if ok else "und" for b, ok in zip(best.tolist(), has.tolist())]
                    score = np.where(has, score, 0.0)
                else:
                    pred, score = ["und"] * part.num_rows, np.zeros(part.num_rows)
                yield pa.record_batch([*(part.column(c) for c in rest), pa.array(pred, pa.string()), pa.array(score)],
                                      names=[*rest, "lang_pred", "score"])

    kinds = ", ".join(f"`{c}` {spec.schema[c].dataType.simpleString()}" for c in rest)
    return map_arrow(spec, judge, f"{kinds}, lang_pred string, score double").withColumnRenamed("id", id_col)
