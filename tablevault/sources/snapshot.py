"""Full and tolerant snapshots (O2, O3) and sync runs into the next version (O5 as a sink).

A target is a folder of versions ``<target>/v=N``. A version is either a whole
table (plain parquet files) or a change: the key buckets it rewrote
(``v=N/_tv_bucket=b``) and a ``_manifest.json`` that says where all other rows are. A
full copy, a batch sync and a stream can share a target: each reads the newest
committed state and writes the next number, past every existing folder, so no
version is ever overwritten. Spark's commit protocol makes a version appear
whole or not at all; the manifest is written before the data, and a version
without ``_SUCCESS`` does not exist for readers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tablevault.functions.columns import any_null, hashable
from tablevault.operators.sync import null_key_leftovers, sync_apply, unique_keys
from tablevault.sources import fs

BUCKET = "_tv_bucket"
MANIFEST = "_manifest.json"
SYNC_BUCKETS = 64
ROWS_PER_FILE = 100_000
CODECS = ("none", "uncompressed", "snappy", "gzip", "lz4", "zstd")


def version_path(target: str, version: int) -> str:
    return f"{target.rstrip('/')}/v={version}"


def latest_version(spark: SparkSession, target: str, below: int | None = None) -> int | None:
    return next(fs.newest_committed(spark, target, None if below is None else below - 1), None)


@dataclass
class State:
    """Where a target's rows are: ``whole`` is a version that holds the whole table,
    ``buckets`` the newer version of each bucket rewritten since, of ``n`` buckets by
    ``keys``. ``streams`` is the last batch taken from each stream."""

    version: int | None = None
    whole: int | None = None
    buckets: dict[int, int] = field(default_factory=dict)
    n: int | None = None
    keys: list[str] = field(default_factory=list)
    streams: dict[str, int] = field(default_factory=dict)


def read_state(spark: SparkSession, target: str, version: int | None = None) -> State:
    """The state as of ``version``, or of the newest committed version."""
    found = None
    for v in fs.newest_committed(spark, target, version):
        text = fs.read_text(spark, f"{version_path(target, v)}/{MANIFEST}")
        if found is None:
            found = State(version=v, whole=v)
        if text is not None:
            m = json.loads(text)
            if found.version == v:
                found = State(v, m["whole"], {int(b): x for b, x in m["buckets"].items()}, m["n"], m["keys"])
            found.streams = m["streams"]  # a full copy in between takes no batch away
            break
    return found or State()


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def read_rows(spark: SparkSession, target: str, state: State, only: Sequence[int] | None = None) -> DataFrame | None:
    """The rows of a state, or of some of its buckets; None if there are none. Columns
    that only some files have are null elsewhere."""
    paths = [f"{version_path(target, v)}/{BUCKET}={b}" for b, v in sorted(state.buckets.items())
             if only is None or b in only]
    parts = [spark.read.option("mergeSchema", "true").parquet(*paths)] if paths else []
    if state.whole is not None:
        rows = spark.read.option("mergeSchema", "true").parquet(version_path(target, state.whole))
        if state.buckets:
            rows = rows.where(~bucket_of(state.keys, state.n).isin(list(state.buckets)))
        if only is not None:
            rows = rows.where(bucket_of(state.keys, state.n).isin(list(only)))
        parts.append(rows)
    if not parts:
        return None
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return rows.drop(SOURCE_FILE, SOURCE_ROW)


def next_version(spark: SparkSession, target: str, first: int = 1) -> int:
    """Past every existing folder, committed or not: none is ever reused."""
    seen = fs.numbers(spark, target)
    return seen[-1] + 1 if seen else first


def write_buckets(incoming: DataFrame, target: str, keys: Sequence[str], buckets: int, state: State, version: int,
                  streams: dict[str, int] | None = None, codec: str = "zstd", rows_per_file: int = ROWS_PER_FILE) -> State:
    """Apply ``incoming`` to ``state`` as ``version``, rewriting only the buckets its keys
    fall in. A state with other keys or another number of buckets is rewritten once.

    A bucket is split by key hash into parts of about ``rows_per_file`` rows (keys are
    hashed; rows with a null key by their content), so the number of tasks follows
    the amount of data and not the number of buckets. Per bucket one count
    reaches the driver.
    """
    spark, keys = incoming.sparkSession, list(keys)
    counts = {r[0]: r[1] for r in incoming.groupBy(bucket_of(keys, buckets)).count().collect()}
    same = state.version is None or not state.buckets or (state.n == buckets and state.keys == keys)
    known = State(state.version, state.whole, dict(state.buckets), buckets, keys) if same else None
    if known is None:
        prev, after = read_rows(spark, target, state), State(version, None, {}, buckets, keys)
        touched = sorted({*counts, *(r[0] for r in prev.select(bucket_of(keys, buckets)).distinct().collect())})
    else:
        touched = sorted(counts)
        prev = read_rows(spark, target, known, touched) if touched else None
        after = known
    after.version, after.streams = version, {**state.streams, **(streams or {})}
    merged = incoming if prev is None else sync_apply(incoming, prev, keys)
    after.buckets |= {b: version for b in touched}
    path = version_path(target, version)
    fs.write_text(spark, f"{path}/{MANIFEST}", json.dumps(
        {"whole": after.whole, "buckets": after.buckets, "n": buckets, "keys": keys, "streams": after.streams}))
    if not touched:
        fs.write_text(spark, f"{path}/_SUCCESS", "")  # nothing to write: the state is the old one
        return after
    rows = sum(counts.values()) + (0 if prev is None else prev.count())  # of files: read off their footers
    parts = max(1, -(-rows // (rows_per_file * len(touched))))
    part = F.when(any_null(keys), F.pmod(F.xxhash64(*[hashable(F.col(f.name), f.dataType) for f in merged.schema]), F.lit(parts * len(touched)))).otherwise(
        F.pmod(F.xxhash64(F.lit(7), *[F.col(k) for k in keys]), F.lit(parts)))
    tasks = min(parts * len(touched), 100_000)
    dealt = merged.withColumn(BUCKET, bucket_of(keys, buckets)).repartition(tasks, F.col(BUCKET), part)
    (dealt.write.mode("append").option("compression", codec).option("maxRecordsPerFile", 2 * rows_per_file)
     .partitionBy(BUCKET).parquet(path))
    return after


def drop_unused(spark: SparkSession, target: str, state: State) -> None:
    """Delete versions below ``state`` that it does not refer to."""
    used = {state.version, state.whole, *state.buckets.values()}
    for v in fs.numbers(spark, target):
        if v < state.version and v not in used:
            fs.delete(spark, version_path(target, v))


def snapshot_full(df: DataFrame, target: str, codec: str = "zstd",
                  version: int | None = None) -> int:
    """Write ``df`` as a new version below ``target``; returns the version.

    The writer never reads ``target``, and the version directory must not
    exist yet, so a snapshot can never overwrite its own input.
    """
    if codec not in CODECS:
        raise ValueError(f"unknown codec {codec!r}; use one of {CODECS}")
    spark = df.sparkSession
    if version is None:
        version = next_version(spark, target)
    df.write.mode("errorifexists").option("compression", codec).parquet(version_path(target, version))
    return version


def read_snapshot(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """The table as of the given version, or as of the newest complete one."""
    state = read_state(spark, target, version)
    if state.version is None or (version is not None and state.version != version):
        raise FileNotFoundError(f"no complete snapshot{'' if version is None else f' {version}'} below {target}")
    rows = read_rows(spark, target, state)
    if rows is None:
        raise FileNotFoundError(f"version {state.version} below {target} holds no files")
    return rows


def changed_rows(src: DataFrame, tgt: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows that are new or differ from what the target holds for their key, and
    rows with a null key that the target does not hold. A non-null key that repeats
    in the source fails the job, as in ``sync_diff``; one that repeats in the target is
    replaced.

    The target's side of the join is its keys and two hashes of the columns that
    the source has; full rows of the target are not shuffled."""
    keys = list(keys)
    rest = [c for c in src.columns if c not in keys]

    def marks(df: DataFrame, side: str) -> list[Column]:
        cols = [F.col(c).cast(src.schema[c].dataType) if c in df.columns else F.lit(None).cast(src.schema[c].dataType)
                for c in rest]
        cols = [hashable(c, src.schema[n].dataType) for c, n in zip(cols, rest)]
        # which columns are null is hashed too: a null leaves a hash as it is
        nulls = F.concat(F.lit(""), *[F.when(c.isNull(), "1").otherwise("0") for c in cols])
        return [F.xxhash64(F.lit(n), *cols, nulls).alias(f"_tv_{side}{n}") for n in (1, 2)]

    # one row for each key of the target, however often it stands there: a key that repeats
    # counts as changed, so the sync replaces all of its rows by the source's one
    old = tgt.where(~any_null(keys)).select(*keys, *marks(tgt, "t")).groupBy(*keys).agg(
        F.count("*").alias("_tv_n"), *[F.max(f"_tv_t{n}").alias(f"_tv_t{n}") for n in (1, 2)])
    new = unique_keys(src.where(~any_null(keys)), keys).select("*", *marks(src, "s"))
    same = (F.col("_tv_n") == 1) & (F.col("_tv_s1") == F.col("_tv_t1")) & (F.col("_tv_s2") == F.col("_tv_t2"))
    out = new.join(old, keys, "left").where(~F.coalesce(same, F.lit(False))).select(*src.columns)
    if any(src.schema[k].nullable for k in keys):
        extra = null_key_leftovers(tgt.select(*[c for c in src.columns if c in tgt.columns]), src, keys)
        out = out.unionByName(extra.select(*src.columns))
    return out


def sync_run(src: DataFrame, target: str, keys, codec: str = "zstd", buckets: int = SYNC_BUCKETS) -> int:
    """One sync run into a versioned target: the source is applied (source wins,
    nothing deleted) to the newest committed state; returns the new version. The
    first run is a full snapshot. A non-null key that repeats in the source fails the
    run and leaves the target as it was; running twice changes nothing, also if the target
    holds repeated keys.

    Only new and changed rows are staged, and only the buckets of their keys are
    rewritten; a run that changes nothing writes a version without data files.
    Rows of columns the source lacks become null in changed rows, as the source
    wins; other rows keep theirs.
    """
    keys, spark = list(keys), src.sparkSession
    state = read_state(spark, target)
    if state.version is None:
        nulls = src.where(any_null(keys))
        return snapshot_full(unique_keys(src.where(~any_null(keys)), keys).unionByName(nulls), target, codec)
    tgt = read_rows(spark, target, state)
    staging = f"{target.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    try:
        (src if tgt is None else changed_rows(src, tgt, keys)).write.parquet(staging)
        version = next_version(spark, target)
        staged = spark.read.schema(src.schema).parquet(staging)
        write_buckets(staged, target, keys, buckets, state, version, codec=codec)
    finally:
        fs.delete(spark, staging)
    return version


SOURCE_FILE, SOURCE_ROW = "_tv_file", "_tv_row"


def plain_file(path: Column) -> Column:
    """A file's path in one spelling: metadata paths are URL-encoded and local ones
    may begin with ``file:///``."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def tolerant_reader(spark: SparkSession, path: str | list[str], schema: StructType | None, fmt: str, recursive: bool,
                    options: dict[str, str] | None = None) -> DataFrame:
    reader = (spark.read.format(fmt).options(**options or {})
              .option("ignoreCorruptFiles", "true")
              .option("ignoreMissingFiles", "true")
              .option("recursiveFileLookup", str(recursive).lower()))
    return (reader.schema(schema) if schema is not None else reader).load(path)


def file_losses(spark: SparkSession, path: str, rows: DataFrame, copied: DataFrame, recursive: bool) -> DataFrame:
    """Files not read whole: ``path``, ``length``, ``rows`` (by the file's footer, null if
    that is unreadable or counts none), ``copied`` and ``lost`` (null like ``rows``)."""
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
               .select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"), "length"))
    # no column is read, so the counts come from the footers
    said = rows.select(plain_file(F.col("_metadata.file_path")).alias("path")).groupBy("path").agg(F.count("*").alias("rows"))
    both = listing.join(said, "path", "left").join(copied, "path", "left").withColumn("copied", F.coalesce("copied", F.lit(0)))
    return both.where(F.col("rows").isNull() | (F.col("copied") < F.col("rows"))).withColumn(
        "lost", F.col("rows") - F.col("copied")).select("path", "length", "rows", "copied", "lost")


def read_tolerant(spark: SparkSession, path: str, schema: StructType | None = None,
                  fmt: str = "parquet", recursive: bool = False) -> tuple[DataFrame, DataFrame]:
    """Read what is readable below ``path`` and list what was not.

    Returns ``(rows, skipped)``: ``rows`` skips unreadable or vanished files, and
    the rest of a file from its first unreadable page; ``skipped`` holds the files
    with the rows they should have, gave and lost (see ``file_losses``), found by
    reading all columns again. A readable file without rows is listed there too.
    Files in plain sub-folders are read and listed only with ``recursive``.
    """
    rows = tolerant_reader(spark, path, schema, fmt, recursive)
    whole = F.xxhash64(*[F.col(c) for c in rows.columns])  # keeps every column in the scan
    copied = rows.select(plain_file(F.col("_metadata.file_path")).alias("path"), whole.alias("h")).groupBy("path").agg(
        (F.count_if(F.col("h") > 0) + F.count_if(F.col("h") <= 0)).alias("copied"))
    return rows, file_losses(spark, path, rows, copied, recursive)


def snapshot_tolerant(spark: SparkSession, path: str, target: str,
                      schema: StructType | None = None, codec: str = "zstd",
                      drop_cols: tuple[str, ...] = (), recursive: bool = False) -> tuple[int, DataFrame]:
    """Copy the readable part of ``path`` to a new snapshot version and
    return ``(version, skipped)``.

    The copy carries each row's file, so the rows that were copied are counted from
    the copy itself; readers do not see that column. The report is written
    beside the version at once and describes this copy."""
    rows = tolerant_reader(spark, path, schema, "parquet", recursive)
    named = rows.select(*[c for c in rows.columns if c not in drop_cols],
                        plain_file(F.col("_metadata.file_path")).alias(SOURCE_FILE))
    version = snapshot_full(named, target, codec)
    copied = spark.read.schema(StructType([StructField(SOURCE_FILE, StringType())])).parquet(
        version_path(target, version)).groupBy(F.col(SOURCE_FILE).alias("path")).agg(F.count("*").alias("copied"))
    report = f"{target.rstrip('/')}/_reports/v={version}"
    losses = file_losses(spark, path, rows, copied, recursive)
    losses.write.parquet(report)
    return version, spark.read.schema(losses.schema).parquet(report)


def copy_steps(skipped: DataFrame, files: DataFrame, run: Column) -> DataFrame:
    """Steps for ``run_outcome``: one per file of ``files`` (``path``), with return code
    1 where the copy left rows out, so that a partial copy does not end as a success."""
    bad = skipped.select("path", F.lit(1).alias("_bad"))
    steps = files.select("path").join(bad, "path", "left")
    return steps.select(run.alias("run_id"), F.xxhash64("path").alias("step_no"), F.coalesce("_bad", F.lit(0)).alias("rc"))
