import datetime as dt

from pyspark.sql import functions as F

from tablevault import operators as op

# three device listings, one more volume attached each time
LISTINGS = [(1, "xvda1", 202, 1, "8G", "/"),
            (2, "xvda1", 202, 1, "8G", "/"), (2, "xvda2", 202, 2, "1G", ""),
            (3, "xvda1", 202, 1, "8G", "/"), (3, "xvda2", 202, 2, "1G", ""), (3, "xvda3", 202, 3, "1G", "")]
LSCHEMA = "snapshot int, name string, major int, minor int, size string, mountpoint string"


def test_latest_entry_is_the_bottom_most_device(spark):
    df = spark.createDataFrame(LISTINGS, LSCHEMA)
    got = {r["snapshot"]: r["name"] for r in op.latest_entry(df, ["snapshot"], ["minor"]).collect()}
    assert got == {1: "xvda1", 2: "xvda2", 3: "xvda3"}


def test_latest_entry_ties_are_stable(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, 1, "z")], "g int, n int, v string")
    got = {r["g"]: r["v"] for r in op.latest_entry(df, ["g"], ["n"]).collect()}
    assert got == {1: "b", 2: "z"}
    assert op.latest_entry(df, ["g"], ["n"]).columns == df.columns


def test_new_entries_between_listings(spark):
    df = spark.createDataFrame(LISTINGS, LSCHEMA).drop("mountpoint")
    cols = ["name", "major", "minor", "size"]
    s2 = df.where("snapshot = 2").select(*cols)
    s3 = df.where("snapshot = 3").select(*cols)
    got = [r["name"] for r in op.new_entries(s3.union(s3), s2).collect()]
    assert got == ["xvda3"]


def _ts(s):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)


def test_wait_profile_poll_arithmetic(spark):
    ev = [("a", _ts(0), "running"), ("a", _ts(5), "terminated"),
          ("b", _ts(0), "terminated"),
          ("c", _ts(0), "running"), ("c", _ts(10), "terminated"),
          ("d", _ts(0), "running"), ("d", _ts(10.000001), "terminated"), ("d", _ts(99), "terminated"),
          ("e", _ts(0), "running")]
    df = spark.createDataFrame(ev, "k string, ts timestamp_ntz, state string")
    got = {r["k"]: (r["polls"], r["slept_s"], r["reported_s"], r["reached"])
           for r in op.wait_profile(df, "k", "ts", "state", "terminated").collect()}
    assert got == {"a": (2, 20, 30, True), "b": (0, 0, 10, True), "c": (2, 20, 30, True),
                   "d": (3, 30, 40, True), "e": (None, None, None, False)}


def test_run_outcome(spark):
    steps = spark.createDataFrame([(1, 1, 0), (1, 2, 0), (2, 1, 0), (2, 2, 1), (2, 3, 1)],
                                  "run_id long, step_no int, rc int")
    rec = F.concat(F.lit("vol-"), F.col("run_id").cast("string"))
    got = {r["run_id"]: (r["exit_code"], r["failed_step"], r["steps"], r["receipt"])
           for r in op.run_outcome(steps, receipt=rec).collect()}
    assert got == {1: (0, None, 2, "vol-1"), 2: (1, 2, 3, None)}


def test_cleanup_plan_order_and_volume(spark):
    led = spark.createDataFrame([(1, "key", 3, True), (1, "instance", 1, True), (1, "group", 2, False),
                                 (1, "volume", 4, True), (1, "key", 3, True), (2, "instance", 1, True)],
                                "run_id long, kind string, kind_order int, created_here boolean")
    got = sorted((r["run_id"], r["step_no"], r["kind"]) for r in op.cleanup_plan(led).collect())
    assert got == [(1, 1, "instance"), (1, 2, "key"), (2, 1, "instance")]
    with_vol = sorted((r["run_id"], r["step_no"], r["kind"])
                      for r in op.cleanup_plan(led, include_volume=True).collect())
    assert (1, 3, "volume") in with_vol


def test_latest_entry_prefers_values_over_nulls(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 3, "b"), (2, None, "c")], "g int, n int, v string")
    got = {r["g"]: (r["n"], r["v"]) for r in op.latest_entry(df, ["g"], ["n"]).collect()}
    assert got == {1: (3, "b"), 2: (None, "c")}
