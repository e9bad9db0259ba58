import pytest
from pyspark.sql import functions as F

from tablevault import operators as op

SRC = [(1, 10.0, "a"), (2, 20.0, "bb"), (3, None, "ccc"), (5, 50.0, "e")]
TGT = [(1, 10.0, "a"), (2, 21.0, "bb"), (3, None, "zz"), (4, 40.0, "dddd")]
SCHEMA = "k long, sig double, payload string"


def test_sync_diff_classes_and_bytes(spark):
    s = spark.createDataFrame(SRC, SCHEMA)
    t = spark.createDataFrame(TGT, SCHEMA)
    got = {r["k"]: (r["cls"], r["bytes"]) for r in op.sync_diff(s, t, ["k"], ["sig"], ["payload"]).collect()}
    # null signature equals null; payload differences alone do not count
    assert got == {1: ("unchanged", 1), 2: ("changed", 2), 3: ("unchanged", 3),
                   4: ("target_only", 4), 5: ("new", 1)}


def test_sync_diff_counts_cover_union_of_keys(spark):
    s = spark.range(0, 1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("sig"))
    t = spark.range(500, 1500).select(F.col("id").alias("k"), (F.col("id") % 5).alias("sig"))
    d = op.sync_diff(s, t, ["k"], ["sig"])
    rep = {r["cls"]: r["rows"] for r in op.sync_report(d, bytes_col=None).collect()}
    assert sum(rep.values()) == 1500
    assert rep["new"] == 500 and rep["target_only"] == 500


def test_sync_diff_rejects_duplicate_keys(spark):
    s = spark.createDataFrame(SRC + [(1, 11.0, "dup")], SCHEMA)
    t = spark.createDataFrame(TGT, SCHEMA)
    with pytest.raises(Exception, match="not unique"):
        op.sync_diff(s, t, ["k"], ["sig"]).collect()


def test_sync_diff_null_keys_do_not_match(spark):
    s = spark.createDataFrame([(None, 1.0, "x"), (None, 2.0, "y")], SCHEMA)
    t = spark.createDataFrame([(None, 1.0, "x")], SCHEMA)
    got = sorted(r["cls"] for r in op.sync_diff(s, t, ["k"], ["sig"]).collect())
    assert got == ["new", "new", "target_only"]


def test_sync_apply_keeps_target_only_and_source_wins(spark):
    s = spark.createDataFrame(SRC, SCHEMA)
    t = spark.createDataFrame(TGT, SCHEMA)
    got = sorted(tuple(r) for r in op.sync_apply(s, t, ["k"]).collect())
    assert got == sorted([(1, 10.0, "a"), (2, 20.0, "bb"), (3, None, "ccc"), (5, 50.0, "e"),
                          (4, 40.0, "dddd")], key=str)


def test_sync_apply_is_idempotent(spark):
    s = spark.createDataFrame(SRC, SCHEMA)
    t = spark.createDataFrame(TGT + [(None, 1.0, "nullkey")], SCHEMA)
    once = op.sync_apply(s, t, ["k"])
    twice = op.sync_apply(s, once, ["k"])
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


def test_sync_report_rows_and_bytes(spark):
    s = spark.createDataFrame(SRC, SCHEMA)
    t = spark.createDataFrame(TGT, SCHEMA)
    rep = {r["cls"]: (r["rows"], r["bytes"])
           for r in op.sync_report(op.sync_diff(s, t, ["k"], ["sig"], ["payload"])).collect()}
    assert rep == {"unchanged": (2, 4), "changed": (1, 2), "target_only": (1, 4), "new": (1, 1)}


def test_sync_apply_with_repeated_keys(spark):
    # sync_apply does not deduplicate: every source row is written, and every
    # target row whose key the source lacks is kept (sync_diff is where keys
    # must be unique)
    s = spark.createDataFrame([(1, 1.0, "a"), (1, 2.0, "a2")], SCHEMA)
    t = spark.createDataFrame([(1, 9.0, "old"), (4, 4.0, "x"), (4, 5.0, "y")], SCHEMA)
    got = sorted(map(tuple, op.sync_apply(s, t, ["k"]).collect()))
    assert got == [(1, 1.0, "a"), (1, 2.0, "a2"), (4, 4.0, "x"), (4, 5.0, "y")]


def test_sync_apply_is_idempotent_with_null_keys_in_the_source(spark):
    s = spark.createDataFrame(SRC + [(None, 1.0, "n"), (None, 1.0, "n"), (None, None, None)], SCHEMA)
    t = spark.createDataFrame(TGT + [(None, 1.0, "n"), (None, 2.0, "own")], SCHEMA)
    once = op.sync_apply(s, t, ["k"])
    rows = sorted(map(tuple, once.collect()), key=str)
    assert [r for r in rows if r[0] is None] == sorted(
        [(None, 1.0, "n"), (None, 1.0, "n"), (None, None, None), (None, 2.0, "own")], key=str)
    again = op.sync_apply(s, op.sync_apply(s, once, ["k"]), ["k"])
    assert sorted(map(tuple, again.collect()), key=str) == rows


def test_sync_apply_joins_a_target_that_is_a_union_once(spark):
    s = spark.createDataFrame(SRC, SCHEMA)
    small = spark.createDataFrame([(6, 1.0, "f"), (5, 1.0, "older")], SCHEMA)
    got = op.sync_apply(s, spark.createDataFrame(TGT, SCHEMA).unionByName(small), ["k"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([*SRC, (4, 40.0, "dddd"), (6, 1.0, "f")], key=str)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
