"""Salvage by row group, diffs by digest, syncs with repeated keys, expiring stream state."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from __spark_entry__ import queries
from tablevault.operators import sync_diff, wait_profile
from tablevault.operators.digests import (
    BUCKET,
    bucket_of,
    differing_buckets,
    digested_copy,
    digests,
    read_digests,
    sync_diff_digest,
)
from tablevault.plans.recovery import damaged_groups
from tablevault.sources import fs
from tablevault.sources.salvage import row_groups, session_conf, snapshot_salvage, split_sizes
from tablevault.sources.snapshot import read_snapshot, read_state, read_rows, snapshot_full, sync_run
from tablevault.streaming import expiring_result, expiring_wait, late_reports, wait_stream_expiring


ORDERS = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
          "o_orderpriority string")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ------------------------------------------------------------------ O3

def _files(spark, path, n=5000, group=1000):
    spark.range(n).selectExpr("id", "sha2(cast(id as string), 256) as s").coalesce(1).write.option(
        "parquet.block.row.count.limit", group).parquet(path)
    (f,) = fs.list_files(spark, path)
    return f


def _damage(spark, path, start, size):
    data = fs.read_bytes(spark, path)
    fs.overwrite_bytes(spark, path, data[:start] + b"\xff" * size + data[start + size:])


@pytest.mark.parametrize("lost", [(0,), (1,), (4,), (0, 2, 3), (0, 1, 2, 3, 4)])
def test_salvage_loses_the_damaged_row_groups_only(spark, workdir, lost):
    f = _files(spark, f"{workdir}/src")
    for _p, k, _first, _rows_, start, size in row_groups(spark, [f]):
        if k in lost:
            _damage(spark, f, start, size)
    v, losses = snapshot_salvage(spark, f"{workdir}/src", f"{workdir}/t")
    got = read_snapshot(spark, f"{workdir}/t", v)
    assert sorted(r["id"] for r in got.collect()) == [i for i in range(5000) if i // 1000 not in lost]
    assert got.columns == ["id", "s"] and got.where("s <> sha2(cast(id as string), 256)").isEmpty()
    assert _rows(losses.select("row_group", "first_row", "rows", "copied", "lost")) == [(k, k * 1000, 1000, 0, 1000) for k in lost]


def test_salvage_of_one_damaged_page_keeps_the_other_groups(spark, workdir):
    f = _files(spark, f"{workdir}/src")
    group = row_groups(spark, [f])[2]
    _damage(spark, f, group[4] + group[5] - 40, 30)  # inside the last column
    v, losses = snapshot_salvage(spark, f"{workdir}/src", f"{workdir}/t")
    (r,) = losses.collect()
    assert (r["row_group"], r["first_row"], r["rows"]) == (2, 2000, 1000) and r["copied"] + r["lost"] == 1000 and r["lost"] > 0
    assert read_snapshot(spark, f"{workdir}/t", v).count() == 5000 - r["lost"]


def test_salvage_reports_files_without_footer_and_vanished_damage(spark, workdir):
    spark.range(30).repartition(3).write.parquet(f"{workdir}/src")
    bad = max(fs.list_files(spark, f"{workdir}/src"), key=lambda f: spark.read.parquet(f).count())
    lost = spark.read.parquet(bad).count()
    fs.overwrite_bytes(spark, bad, b"not parquet")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    v, losses = snapshot_salvage(spark, f"{workdir}/src", f"{workdir}/t", schema=spark.range(1).schema)
    assert read_snapshot(spark, f"{workdir}/t", v).count() == 30 - lost
    (r,) = losses.collect()
    assert r["row_group"] is None and r["lost"] is None and r["path"].endswith(bad.rsplit("/", 1)[-1])
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_salvage_without_damage_reads_once_and_reports_nothing(spark, workdir):
    _files(spark, f"{workdir}/src")
    v, losses = snapshot_salvage(spark, f"{workdir}/src", f"{workdir}/t")
    assert losses.isEmpty() and read_snapshot(spark, f"{workdir}/t", v).count() == 5000
    assert len(fs.list_files(spark, f"{workdir}/t/v={v}")) == 1


def test_salvage_reads_only_damaged_files_again_whatever_their_names(spark, workdir):
    src = f"{workdir}/so urce 100%"
    spark.range(6000).selectExpr("id", "cast(id div 2000 as int) as p").repartition("p").sortWithinPartitions("id").write.option(
        "parquet.block.row.count.limit", 500).partitionBy("p").parquet(src)
    (f,) = fs.list_files(spark, f"{src}/p=1")
    _p, _k, _first, _n, start, size = row_groups(spark, [f])[1]
    _damage(spark, f, start, size)
    v, losses = snapshot_salvage(spark, src, f"{workdir}/t")
    got = read_snapshot(spark, f"{workdir}/t", v)
    assert sorted(map(tuple, got.select("id", "p").collect())) == [(i, i // 2000) for i in range(6000) if not 2500 <= i < 3000]
    assert [(r["row_group"], r["lost"]) for r in losses.collect()] == [(1, 500)]
    v, losses = snapshot_salvage(spark, f, f"{workdir}/one")  # a single file
    assert read_snapshot(spark, f"{workdir}/one", v).count() == 1500 and losses.count() == 1


def test_salvage_reads_many_damaged_files_in_few_tasks(spark, workdir):
    spark.range(60_000).selectExpr("id", "sha2(cast(id as string), 256) as s").coalesce(1).write.option(
        "parquet.block.row.count.limit", 200).option("maxRecordsPerFile", 1000).parquet(f"{workdir}/src")
    groups = row_groups(spark, fs.list_files(spark, f"{workdir}/src"))
    fs.overwrite_parts(spark, [(path, start, size) for path, k, _first, _n, start, size in groups if k == 2], 0xFF)
    sc = spark.sparkContext
    sc.setJobGroup(workdir, "salvage")
    try:
        v, losses = snapshot_salvage(spark, f"{workdir}/src", f"{workdir}/t")
    finally:
        sc.setJobGroup("", "")
    seen = sc.statusTracker()
    jobs = [seen.getJobInfo(j) for j in seen.getJobIdsForGroup(workdir)]
    stages = [seen.getStageInfo(i) for job in jobs if job for i in job.stageIds]
    assert max(x.numTasks for x in stages if x) <= 5 * sc.defaultParallelism  # of 300 row groups
    assert read_snapshot(spark, f"{workdir}/t", v).count() == 48_000
    assert losses.count() == 60 and {(r["row_group"], r["lost"]) for r in losses.collect()} == {(2, 200)}


def test_parts_of_files_are_overwritten(spark, workdir):
    f = _files(spark, f"{workdir}/src", 10)
    data = fs.read_bytes(spark, f)
    fs.overwrite_parts(spark, [(f, 4, 50)], 0xFF)
    assert fs.read_bytes(spark, f) == data[:4] + b"\xff" * 50 + data[54:]


def test_damaged_fixture_has_whole_files_in_key_order(spark, workdir):
    spark.createDataFrame([(k, 1, "O", 1.0, dt.datetime(2024, 1, 1), "1-URGENT") for k in range(0, 30_000, 2)], ORDERS).repartition(
        7).write.parquet(f"{workdir}/orders.parquet")
    damaged_groups(spark, workdir, f"{workdir}/d")
    rows = spark.read.parquet(f"{workdir}/d/part=1").groupBy(F.input_file_name()).agg(
        F.count("*"), F.min("o_orderkey"), F.max("o_orderkey")).collect()
    got = sorted(tuple(r)[1:] for r in rows)
    assert got == sorted((len(x), x[0], x[-1]) for x in (list(range(4, 30_000, 6))[i:i + 2000] for i in range(0, 5000, 2000)))


def test_split_sizes_hold_one_middle_each():
    groups = [("a", 0, 0, 9, 4, 100_000), ("a", 1, 9, 9, 100_004, 90_000), ("a", 2, 18, 1, 190_004, 50), ("b", 0, 0, 9, 4, 10)]
    sizes = split_sizes(groups)
    middles = [50_004, 145_004, 190_029]
    assert len({int(m // sizes["a"]) for m in middles}) == 3 and sizes["a"] & (sizes["a"] - 1) == 0


def test_session_conf_is_put_back(spark):
    with pytest.raises(ZeroDivisionError), session_conf(spark, spark__sql__files__maxPartitionBytes="4096", a__b="x"):
        assert spark.conf.get("a.b") == "x"
        1 / 0
    assert spark.conf.get("a.b", None) is None


# ------------------------------------------------------------------ O4

SCHEMA = "k long, v string, w double, extra map<string,int>"


def _pair(spark):
    src = [(k, f"v{k % 9}" if k % 11 else None, float(k) if k % 7 else None, {"a": k, "b": 1}) for k in range(400)]
    tgt = [(k, "changed" if k in (5, 77) else v, w, {"b": 1, "a": k}) for k, v, w, _ in src if k not in (3, 200)]
    tgt += [(1000, "only here", 1.0, None), (None, "v", 1.0, None), (None, "v", 1.0, None)]
    src += [(None, "v", 1.0, None), (None, None, None, None)]
    return (spark.createDataFrame(rows, SCHEMA).repartition(4) for rows in (src, tgt))


def test_diff_by_digest_equals_the_full_diff(spark, workdir):
    src, tgt = _pair(spark)
    digested_copy(tgt, f"{workdir}/copy", ["k"], ["v", "w"], buckets=64)
    got = sync_diff_digest(src, f"{workdir}/copy", ["k"], ["v", "w"], ["v"])
    want = sync_diff(src, tgt, ["k"], ["v", "w"], ["v"])
    assert _rows(got) == _rows(want.select(*got.columns))


def test_equal_buckets_of_the_copy_are_not_read(spark, workdir):
    src, tgt = _pair(spark)
    digested_copy(tgt, f"{workdir}/copy", ["k"], ["v", "w"], buckets=64)
    marks, n = read_digests(spark, f"{workdir}/copy", ["k"], ["v", "w"])
    differ = differing_buckets(digests(src, ["k"], ["v", "w"], n), marks, n)
    touched = src.unionByName(tgt).where("k in (3, 5, 77, 200, 1000) or k is null").select(bucket_of(["k"], 64)).distinct()
    assert set(differ) == {r[0] for r in touched.collect()}  # nothing but what differs
    want = _rows(sync_diff(src, tgt, ["k"], ["v", "w"]))
    for name in fs.list_dirs(spark, f"{workdir}/copy"):
        if name.startswith(f"{BUCKET}=") and int(name.split("=")[1]) not in differ:
            for f in fs.list_files(spark, f"{workdir}/copy/{name}"):
                fs.overwrite_bytes(spark, f, b"unreadable")
    assert _rows(sync_diff_digest(src, f"{workdir}/copy", ["k"], ["v", "w"])) == want


def test_digests_see_swapped_and_moved_nulls(spark):
    a = spark.createDataFrame([(1, None, 2.0, None)], SCHEMA)
    b = spark.createDataFrame([(1, "2.0", None, None)], SCHEMA)
    c = spark.createDataFrame([(1, None, 2.0, None)] * 3, SCHEMA)
    d = [digests(x, ["k"], ["v", "w"], 8) for x in (a, b, c)]
    assert differing_buckets(d[0], d[1], 8) and differing_buckets(d[0], d[2], 8) and not differing_buckets(d[0], d[0], 8)


def test_digest_copies_of_odd_tables(spark, workdir):
    src, tgt = _pair(spark)
    empty = src.limit(0)
    digested_copy(empty, f"{workdir}/empty", ["k"], ["v"])
    assert {r["cls"] for r in sync_diff_digest(src, f"{workdir}/empty", ["k"], ["v"]).collect()} == {"new"}
    digested_copy(tgt, f"{workdir}/copy", ["k"], ["v"], buckets=2000)
    assert {r["cls"] for r in sync_diff_digest(empty, f"{workdir}/copy", ["k"], ["v"]).collect()} == {"target_only"}
    with pytest.raises(ValueError, match="other columns"):
        sync_diff_digest(src, f"{workdir}/copy", ["k"], ["w"])
    with pytest.raises(Exception, match="not unique"):
        digested_copy(src.unionByName(src), f"{workdir}/twice", ["k"], ["v"])
    with pytest.raises(Exception, match="not unique"):
        sync_diff_digest(src.unionByName(src), f"{workdir}/copy", ["k"], ["v"]).collect()


def test_a_copy_that_repeats_keys_is_compared_row_by_row(spark, workdir):
    src, _ = _pair(spark)
    key = src.where("k is not null").select("k").distinct().orderBy("k").first()[0]
    tgt = src.unionByName(src.where(F.col("k") == key).withColumn("v", F.lit("other").cast(src.schema["v"].dataType)))
    digested_copy(tgt, f"{workdir}/copy", ["k"], ["v"], buckets=8, repeats=True)
    got = sync_diff_digest(src, f"{workdir}/copy", ["k"], ["v"])
    assert _rows(got) == _rows(sync_diff(src, tgt, ["k"], ["v"], target_repeats=True))
    assert sorted(r["cls"] for r in got.where(F.col("k") == key).collect()) == ["changed", "unchanged"]
    # a source with the same repeats has the same digests, and is found out all the same
    with pytest.raises(Exception, match="not unique"):
        sync_diff_digest(tgt, f"{workdir}/copy", ["k"], ["v"]).collect()


def test_diffs_of_orders_past_the_shifted_keys(spark, workdir):
    """The older copy repeats keys once ``orders`` reaches its shifted ones."""
    base = [49, 50, 100, 150, 1_000_050, 1_000_100, 1_000_149]
    spark.createDataFrame([(k, 1, "O", float(k), dt.datetime(2024, 1, 1), "1-URGENT") for k in base], ORDERS).write.parquet(
        f"{workdir}/orders.parquet")
    want = sorted([(49, "unchanged", 9), (50, "changed", 9), (150, "changed", 9), (100, "new", 9), (1_000_050, "changed", 9),
                   (1_000_050, "changed", 9), (1_000_100, "changed", 9), (1_000_149, "unchanged", 9), (1_000_150, "target_only", 9),
                   (2_000_050, "target_only", 9), (2_000_100, "target_only", 9)])
    for name in ("sync_diff", "sync_diff_digest"):
        got = queries()[name](spark, workdir).select("o_orderkey", "cls", "bytes")
        assert sorted(map(tuple, got.collect())) == want
    report = {r["cls"]: r["rows"] for r in queries()["sync_report"](spark, workdir).collect()}
    assert report == {"unchanged": 2, "changed": 5, "new": 1, "target_only": 3}


# ------------------------------------------------------------------ O5

def test_sync_run_of_repeated_target_keys_is_idempotent(spark, workdir):
    schema = "k long, v string, m map<string,int>"
    old = [(1, "a", {"x": 1})] * 3 + [(2, "b", None), (9, "stays", None), (9, "stays", None)]
    src = spark.createDataFrame([(1, "a", {"x": 1}), (2, "b", None), (3, "c", {"y": 2})], schema)
    snapshot_full(spark.createDataFrame(old, schema), f"{workdir}/t")
    counts = []
    for _ in range(4):
        v = sync_run(src, f"{workdir}/t", ["k"])
        counts.append(read_snapshot(spark, f"{workdir}/t", v).count())
    assert counts == [5] * 4  # 1, 2, 3 once; 9 twice, as it is not the source's
    state = read_state(spark, f"{workdir}/t")
    assert _rows(read_rows(spark, f"{workdir}/t", state).select("k", "v")) == [(1, "a"), (2, "b"), (3, "c"), (9, "stays"), (9, "stays")]


def test_sync_run_refuses_repeated_source_keys_and_leaves_the_target(spark, workdir):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (1, "a"), (None, "n"), (None, "n")], "k long, v string")
    with pytest.raises(Exception, match="not unique"):
        sync_run(rows, f"{workdir}/t", ["k"])
    ok = rows.where("k is null or v = 'b'")
    v = sync_run(ok, f"{workdir}/t", ["k"])
    with pytest.raises(Exception, match="not unique"):
        sync_run(rows, f"{workdir}/t", ["k"])
    assert _rows(read_snapshot(spark, f"{workdir}/t")) == _rows(read_snapshot(spark, f"{workdir}/t", v)) == _rows(ok)
    assert not fs.list_dirs(spark, f"{workdir}/t/_staging")


# ------------------------------------------------------------------ O22

STATES = "k long, ts timestamp, state string"
HDFS_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def _at(s):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)


def _feed(spark, workdir, drops, delay="10 seconds", expiry_s=60):
    totals = []
    for n, rows in enumerate(drops):
        spark.createDataFrame(rows, STATES).coalesce(1).write.parquet(f"{workdir}/in/part={n}")
        src = spark.readStream.schema(STATES).parquet(f"{workdir}/in")
        q = wait_stream_expiring(src, "k", "ts", "state", "t", f"{workdir}/out", f"{workdir}/ck", delay, expiry_s)
        q.awaitTermination()
        totals.append(q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    return totals


def test_expiring_wait_equals_the_batch_profile_and_reports_late_events(spark, workdir):
    drops = [[(1, _at(0), "a"), (2, _at(5), "t"), (1, _at(8), "t"), (None, _at(1), "t"), (7, None, "t")],
             [(3, _at(100), "a"), (1, _at(1), "t"), (5, _at(89), None)],  # 1 was not late yet: the watermark stood before 0
             [(4, _at(300), "a"), (3, _at(20), "t"), (4, _at(310), "t")],
             [(1, _at(320), "a"), (3, _at(-50), "a")]]
    _feed(spark, workdir, drops)
    rows = spark.createDataFrame([r for d in drops for r in d if r[0] is not None and r[1] is not None], STATES)
    got = expiring_result(spark, f"{workdir}/out", "k")
    assert _rows(got) == _rows(wait_profile(rows, "k", "ts", "state", "t").select(*got.columns))
    late = late_reports(spark, f"{workdir}/out", "k")
    assert _rows(late.select("k", "ts", "state")) == sorted([(3, _at(20), "t"), (3, _at(-50), "a")], key=str)
    on_time = expiring_result(spark, f"{workdir}/out", "k", with_late=False).where("k = 3").first()
    assert on_time["started"] == _at(100) and not on_time["reached"]


def test_state_follows_the_active_keys(spark, workdir):
    drops = [[(100 * d + k, _at(1000 * d + k), "a") for k in range(40)] for d in range(5)]
    totals = _feed(spark, workdir, drops)
    assert all(t <= 40 for t in totals)  # of 200 keys ever seen
    assert expiring_result(spark, f"{workdir}/out", "k").count() == 200


def test_expiring_wait_brings_its_state_store(spark, workdir):
    plain = spark.newSession()
    plain.conf.set("spark.sql.streaming.stateStore.providerClass", HDFS_STORE)
    totals = _feed(plain, workdir, [[(1, _at(0), "a")], [(1, _at(5), "t"), (2, _at(6), "a")]])
    assert totals == [1, 2] and plain.conf.get("spark.sql.streaming.stateStore.providerClass") == HDFS_STORE
    assert expiring_result(plain, f"{workdir}/out", "k").count() == 2


def test_expiring_wait_needs_no_package_on_the_workers():
    made = cloudpickle.dumps(expiring_wait.ExpiringWait("t", 1000))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    code = "import pickle, sys; print(pickle.loads(sys.stdin.buffer.read()).expiry_ms, 'tablevault' in sys.modules)"
    said = subprocess.run([sys.executable, "-c", code], input=made, cwd="/", env=env, capture_output=True, check=True).stdout
    assert said.split() == [b"1000", b"False"]
