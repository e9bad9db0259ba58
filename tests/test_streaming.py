import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablevault import operators as op
from tablevault.plans import catalog, fixtures
from tablevault.sources.snapshot import latest_version, read_snapshot, snapshot_full
from tablevault.sources.tables import table
from tablevault.streaming import apply_batch, sync_stream, wait_stream, wait_stream_result
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_sync_stream_drained_equals_batch(spark):
    got = catalog.q_sync_stream(spark, SF_SMALL)
    ev = table(spark, SF_SMALL, "events")
    want = op.latest_entry(ev, ["user_id"], ["event_id"])
    assert _rows(got) == _rows(want.select(*got.columns))


def test_sync_stream_later_arrival_wins_and_replay_is_idempotent(spark, workdir):
    schema = "k long, n long, v string"
    b0 = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (2, 1, "c")], schema)
    b1 = spark.createDataFrame([(1, 3, "late-but-newer-arrival"), (3, 1, "d")], schema)
    apply_batch(b0, 0, workdir, ["k"], "n")
    apply_batch(b1, 1, workdir, ["k"], "n")
    first = _rows(read_snapshot(spark, workdir))
    apply_batch(b1, 1, workdir, ["k"], "n")  # replay of batch 1
    assert _rows(read_snapshot(spark, workdir)) == first
    assert latest_version(spark, workdir) == 1
    assert first == [(1, 3, "late-but-newer-arrival"), (2, 1, "c"), (3, 1, "d")]


def test_sync_stream_from_files(spark, workdir):
    src_dir = f"{workdir}/in"
    spark.createDataFrame([(1, 1, "x"), (2, 1, "y")], "k long, n long, v string").write.parquet(f"{src_dir}/a")
    stream = spark.readStream.schema("k long, n long, v string").parquet(f"{src_dir}/a")
    sync_stream(stream, f"{workdir}/t", ["k"], "n", f"{workdir}/ck").awaitTermination()
    assert _rows(read_snapshot(spark, f"{workdir}/t")) == [(1, 1, "x"), (2, 1, "y")]


def test_wait_stream_drained_equals_batch(spark):
    got = catalog.q_wait_stream(spark, SF_SMALL)
    want = op.wait_profile(fixtures.instance_states(spark, SF_SMALL), "instance", "ts", "state", "terminated")
    assert _rows(got) == _rows(want.select(*got.columns))


def test_wait_stream_accepts_late_events(spark, workdir):
    base = dt.datetime(2024, 1, 1)
    schema = "k string, ts timestamp_ntz, state string"
    d1 = [("a", base + dt.timedelta(seconds=30), "running"), ("a", base + dt.timedelta(seconds=40), "terminated")]
    d2 = [("a", base + dt.timedelta(seconds=5), "running")]  # late: lowers the first-seen time
    spark.createDataFrame(d1, schema).write.parquet(f"{workdir}/in/part=0")
    out, ck = f"{workdir}/out", f"{workdir}/ck"

    def run():
        s = spark.readStream.schema(schema + ", part int").parquet(f"{workdir}/in").drop("part")
        wait_stream(s, "k", "ts", "state", "terminated", out, ck).awaitTermination()

    run()
    spark.createDataFrame(d2, schema).write.parquet(f"{workdir}/in/part=1")
    run()
    res = wait_stream_result(spark, out, "k").withColumn("started", F.col("started").cast("timestamp_ntz"))
    (r,) = res.collect()
    assert r["polls"] == 5 and r["reached"]  # T = 40 - 5 = 35 s -> ceil(3.5) + 1
    assert r["started"] == base + dt.timedelta(seconds=5)


def test_bucketed_sync_rewrites_only_touched_buckets(spark, workdir):
    from tablevault.sources import fs
    from tablevault.streaming import bucket_versions, read_synced
    from tablevault.streaming.versioned_sync import bucket_of

    schema = "k long, n long, v string"
    base = spark.range(200).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("n"),
                                   F.lit("old").alias("v"))
    apply_batch(base, 0, workdir, ["k"], "n", buckets=8)
    assert len(bucket_versions(spark, workdir)) == 8
    # a batch whose keys all fall in one bucket
    b0 = spark.range(200).select(F.col("id").alias("k"), bucket_of(["k"], 8).alias("b")) \
        .where("b = 3").limit(3).select("k", F.lit(2).cast("long").alias("n"), F.lit("new").alias("v"))
    b1 = spark.createDataFrame([(r["k"], r["n"], r["v"]) for r in b0.collect()], schema)
    apply_batch(b1, 1, workdir, ["k"], "n", buckets=8)
    assert fs.list_dirs(spark, f"{workdir}/v=1") == ["_tv_bucket=3"]
    versions = bucket_versions(spark, workdir)
    assert versions[3] == 1 and all(v == 0 for b, v in versions.items() if b != 3)
    got = read_synced(spark, workdir, buckets=8)
    assert got.count() == 200
    assert got.where("v = 'new'").count() == 3
    first = _rows(got)
    apply_batch(b1, 1, workdir, ["k"], "n", buckets=8)  # replay
    assert _rows(read_synced(spark, workdir, buckets=8)) == first


def test_dropping_superseded_versions_keeps_the_table_and_replays(spark, workdir):
    from tablevault.sources import fs
    from tablevault.streaming import read_synced

    schema = "k long, n long, v string"
    batches = [
        spark.createDataFrame([(k, 1, "a") for k in range(40)], schema),           # all buckets
        spark.createDataFrame([(k, 2, "b") for k in range(40)], schema),           # all buckets again
        spark.createDataFrame([(1, 3, "c"), (2, 3, "c")], schema),                  # a few buckets
    ]
    for i, b in enumerate(batches):
        apply_batch(b, i, workdir, ["k"], "n", buckets=4, keep_history=False)
    # v=0 is fully replaced by v=1, and v=2 runs after v=1 committed
    assert fs.versions(spark, workdir) == [1, 2]
    want = sorted([(k, 2, "b") for k in range(40) if k not in (1, 2)] + [(1, 3, "c"), (2, 3, "c")], key=str)
    assert _rows(read_synced(spark, workdir, buckets=4)) == want
    apply_batch(batches[2], 2, workdir, ["k"], "n", buckets=4, keep_history=False)  # replay
    assert _rows(read_synced(spark, workdir, buckets=4)) == want


@pytest.mark.parametrize("keep_state", [True, False])
def test_wait_stream_takes_events_however_late(spark, workdir, keep_state):
    base = dt.datetime(2024, 1, 1)
    schema = "k string, ts timestamp_ntz, state string"
    drops = [[("a", 30, "running"), ("a", 40, "terminated")], [("a", 5, "running")], [("b", 6, "running")],
             [("b", 2, "terminated")]]
    out, ck = f"{workdir}/out", f"{workdir}/ck"
    for k, rows in enumerate(drops):
        spark.createDataFrame([(a, base + dt.timedelta(seconds=t), s) for a, t, s in rows], schema) \
            .write.parquet(f"{workdir}/in/part={k}")
        src = spark.readStream.schema(schema + ", part int").parquet(f"{workdir}/in").drop("part")
        wait_stream(src, "k", "ts", "state", "terminated", out, ck, keep_state=keep_state,
                    compact_every=2).awaitTermination()
    got = {r["k"]: (r["started"], r["polls"], r["reached"]) for r in wait_stream_result(spark, out, "k").collect()}
    assert got == {"a": (base + dt.timedelta(seconds=5), 5, True), "b": (base + dt.timedelta(seconds=2), 0, True)}
    from tablevault.sources import fs
    assert len(fs.list_dirs(spark, out)) == 1  # folded after the fourth batch


def test_rows_without_an_order_value_are_fed(spark, workdir):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (9, "c")], "event_id long, v string")
    catalog._drop_in_ranges(spark, df, "event_id", 2, f"{workdir}/in", lambda: None)
    assert spark.read.parquet(f"{workdir}/in").count() == 3


LAYOUTS = [None, 4]
KNV = "k long, n long, v string"


@pytest.mark.parametrize("buckets", LAYOUTS)
def test_batches_go_on_from_a_seeded_target(spark, workdir, buckets):
    from tablevault.streaming import read_synced

    snapshot_full(spark.createDataFrame([(1, 0, "seed"), (9, 0, "only here")], KNV), workdir)  # v=1
    apply_batch(spark.createDataFrame([(1, 1, "b0"), (2, 1, "b0")], KNV), 0, workdir, ["k"], "n", buckets)
    apply_batch(spark.createDataFrame([(2, 2, "b1")], KNV), 1, workdir, ["k"], "n", buckets)
    want = [(1, 1, "b0"), (2, 2, "b1"), (9, 0, "only here")]
    assert _rows(read_synced(spark, workdir, buckets)) == want
    assert _rows(read_snapshot(spark, workdir, 1)) == [(1, 0, "seed"), (9, 0, "only here")]  # untouched
    # a fresh stream starts at batch 0 again, on what is there
    apply_batch(spark.createDataFrame([(3, 1, "other")], KNV), 0, workdir, ["k"], "n", buckets, stream_id="fresh")
    assert _rows(read_synced(spark, workdir, buckets)) == [*want[:2], (3, 1, "other"), want[2]]
    # replays of either stream change nothing
    before = latest_version(spark, workdir)
    apply_batch(spark.createDataFrame([(2, 2, "b1")], KNV), 1, workdir, ["k"], "n", buckets)
    apply_batch(spark.createDataFrame([(3, 1, "other")], KNV), 0, workdir, ["k"], "n", buckets, stream_id="fresh")
    assert latest_version(spark, workdir) == before


@pytest.mark.parametrize("buckets", LAYOUTS)
def test_batches_keep_null_keys_and_target_only_columns(spark, workdir, buckets):
    from tablevault.streaming import read_synced

    wide = "k long, n long, v string, extra string"
    apply_batch(spark.createDataFrame([(k, 1, "a", f"keep{k}") for k in range(8)], wide), 0, workdir, ["k"], "n", buckets)
    batch = spark.createDataFrame([(1, 2, "b"), (None, 1, "x"), (None, 2, "y"), (None, 2, "y")], KNV)
    apply_batch(batch, 1, workdir, ["k"], "n", buckets)
    got = _rows(read_synced(spark, workdir, buckets).select("k", "n", "v", "extra"))
    want = [(1, 2, "b", None), (None, 1, "x", None), (None, 2, "y", None), (None, 2, "y", None)]
    want += [(k, 1, "a", f"keep{k}") for k in range(8) if k != 1]
    assert got == sorted(want, key=str)
    apply_batch(batch, 2, workdir, ["k"], "n", buckets)  # the same rows again: null keys do not pile up
    assert _rows(read_synced(spark, workdir, buckets).select("k", "n", "v", "extra")) == got


def test_a_full_copy_a_sync_and_a_stream_share_a_target(spark, workdir):
    from tablevault.sources.snapshot import sync_run
    from tablevault.streaming import read_synced

    apply_batch(spark.createDataFrame([(1, 1, "s"), (2, 1, "s")], KNV), 0, workdir, ["k"], "n", 4)
    sync_run(spark.createDataFrame([(2, 5, "sync"), (3, 5, "sync")], KNV), workdir, ["k"], buckets=4)
    assert _rows(read_snapshot(spark, workdir)) == [(1, 1, "s"), (2, 5, "sync"), (3, 5, "sync")]
    snapshot_full(spark.createDataFrame([(7, 1, "full")], KNV), workdir)  # replaces what was there
    apply_batch(spark.createDataFrame([(8, 1, "s")], KNV), 1, workdir, ["k"], "n", 8)  # other buckets
    sync_run(spark.createDataFrame([(7, 2, "sync")], KNV), workdir, ["k"])  # and others again
    assert _rows(read_synced(spark, workdir, 8)) == [(7, 2, "sync"), (8, 1, "s")]
    apply_batch(spark.createDataFrame([(8, 1, "late replay")], KNV), 1, workdir, ["k"], "n", 8)
    assert _rows(read_snapshot(spark, workdir)) == [(7, 2, "sync"), (8, 1, "s")]


def test_a_fresh_checkpoint_is_another_stream(spark, workdir):
    def run(name, rows):
        spark.createDataFrame(rows, KNV).write.parquet(f"{workdir}/{name}")
        stream = spark.readStream.schema(KNV).parquet(f"{workdir}/{name}")
        sync_stream(stream, f"{workdir}/t", ["k"], "n", f"{workdir}/ck-{name}", buckets=4).awaitTermination()

    run("a", [(1, 1, "a"), (2, 1, "a")])
    run("b", [(2, 2, "b"), (3, 1, "b")])
    assert _rows(read_snapshot(spark, f"{workdir}/t")) == [(1, 1, "a"), (2, 2, "b"), (3, 1, "b")]


def test_a_bucket_is_written_by_many_tasks(spark, workdir):
    from tablevault.sources import fs

    big = spark.range(2_000_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"),  # a third without a key
                                        F.lit(1).cast("long").alias("n"), F.col("id").cast("string").alias("v"))
    apply_batch(big, 0, workdir, ["k"], "n", buckets=16)
    files = [f for d in fs.list_dirs(spark, f"{workdir}/v=0") for f in fs.list_files(spark, f"{workdir}/v=0/{d}")]
    assert len(files) > 16
    rows = [r["count"] for r in spark.read.parquet(*files).groupBy(F.input_file_name()).count().collect()]
    assert sum(rows) == 2_000_000 and max(rows) <= 200_000
