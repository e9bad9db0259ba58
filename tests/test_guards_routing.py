from tablevault import operators as op

REQ = [(1, "dd", "vol-1", 10), (2, "rsync", None, 10), (3, "", "", 10), (4, None, "vol-9", 10),
       (5, "tar", "vol-1", 10), (6, "dd", "vol-2", None), (7, "rsync", "vol-2", 99), (8, "dd", None, 11)]
REQ_SCHEMA = "request_id int, method string, volume_id string, source_id long"
VOL = [("vol-1", "us-east-1a", "data"), ("vol-2", "us-east-1b", "ext4"), ("vol-3", "us-east-1c", "xfs"),
       ("vol-2", "us-east-1b", "ext4")]
VOL_SCHEMA = "volume_id string, zone string, fs string"


def _frames(spark):
    req = spark.createDataFrame(REQ, REQ_SCHEMA)
    vol = spark.createDataFrame(VOL, VOL_SCHEMA)
    src = spark.createDataFrame([(10,), (11,)], "source_id long")
    return req, vol, src


def test_refs_present_and_missing_split_the_input(spark):
    req, vol, _ = _frames(spark)
    present = {r["request_id"] for r in op.refs_present(req, vol, "volume_id").collect()}
    missing = {r["request_id"] for r in op.refs_missing(req, vol, "volume_id").collect()}
    assert present == {1, 5, 6, 7}
    assert missing == {2, 3, 4, 8}
    assert op.refs_present(req, vol, "volume_id").count() == 4  # duplicate inventory rows do not multiply


def test_validate_requests_first_failing_rule(spark):
    req, vol, src = _frames(spark)
    got = {r["request_id"]: (r["method"], r["verdict"]) for r in op.validate_requests(req, vol, src).collect()}
    assert got == {1: ("dd", "ok"), 2: ("rsync", "ok"), 3: ("dd", "volume_blank"), 4: ("dd", "volume_unknown"),
                   5: ("tar", "bad_method"), 6: ("dd", "source_missing"), 7: ("rsync", "source_unknown"),
                   8: ("dd", "ok")}


def test_placement_conflicts_only_for_supplied_volumes(spark):
    req, vol, _ = _frames(spark)
    workers = spark.createDataFrame([(10, "i-a", "us-east-1a"), (99, "i-b", "us-east-1a"), (11, "i-c", None)],
                                    "source_id long, instance_id string, zone string")
    got = {(r["request_id"], r["volume_zone"], r["instance_zone"])
           for r in op.placement_conflicts(req, vol, workers).collect()}
    # request 1 (vol-1 in 1a, worker in 1a) is fine; 7 uses vol-2 (1b) from a 1a worker
    assert got == {(7, "us-east-1b", "us-east-1a")}


def test_route_plan_four_combinations(spark):
    plans = spark.createDataFrame([("dd", "vol-1"), ("dd", None), ("rsync", "vol-1"), ("rsync", ""),
                                   (None, "vol-1"), ("tar", None)], "method string, volume_id string")
    got = [r["plan"] for r in op.route_plan(plans).collect()]
    assert got == ["a", "b", "c", "d", "a", None]


def test_route_prepare_rules(spark):
    req, vol, _ = _frames(spark)
    vol = vol.union(spark.createDataFrame([("vol-4", "z", "ffs")], VOL_SCHEMA))
    extra = spark.createDataFrame([(9, "dd", "vol-3", 10), (10, "dd", "vol-4", 10)], REQ_SCHEMA)
    got = {r["request_id"]: r["action"] for r in op.route_prepare(req.union(extra), vol).collect()}
    assert got == {1: "format_mount", 2: "create", 3: "create", 4: "reject", 5: "format_mount",
                   6: "mount", 7: "mount", 8: "create", 9: "rollback", 10: "mount"}


def test_route_state(spark):
    df = spark.createDataFrame([("running",), ("pending",), ("stopped",), ("terminated",)], "state string")
    assert [r["action"] for r in op.route_state(df).collect()] == ["proceed", "wait", "start", None]


def test_route_first_match_takes_the_first_true_rule(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(5,), (50,), (500,), (None,)], "n int")
    rules = [(F.col("n") < 10, "small"), (F.col("n") < 100, "medium"), (F.col("n") < 1000, "large"),
             (F.col("n") < 10, "never reached")]
    got = [r["size"] for r in op.route_first_match(df, rules, "size", default="unknown").collect()]
    assert got == ["small", "medium", "large", "unknown"]


def test_numeric_ids_are_never_blank(spark):
    req = spark.createDataFrame([(1, "dd", 7, 1), (2, None, None, 1), (3, "dd", 8, 2)],
                                "request_id long, method string, volume_id long, source_id long")
    vols = spark.createDataFrame([(7, "z1", "ext4"), (7, "z1", "ext4")], "volume_id long, zone string, fs string")
    workers = spark.createDataFrame([(1, "i-1", "z2"), (1, "i-1", "z2")], "source_id long, instance_id string, zone string")
    got = op.placement_conflicts(req, vols, workers).collect()
    assert [(r["request_id"], r["volume_id"]) for r in got] == [(1, 7)]  # once, though listed twice
    assert {r["request_id"]: r["plan"] for r in op.route_plan(req).collect()} == {1: "a", 2: "b", 3: "a"}
    assert {r["request_id"]: r["action"] for r in op.route_prepare(req, vols).collect()} == {1: "mount", 2: "create", 3: "reject"}
    verdicts = op.validate_requests(req, vols, spark.createDataFrame([(1,)], "source_id long"))
    assert {r["request_id"]: r["verdict"] for r in verdicts.collect()} == {1: "ok", 2: "ok", 3: "volume_unknown"}


def test_maps_and_clashing_columns_in_requests(spark):
    from pyspark.sql import functions as F
    from tablevault import operators as op
    req = spark.createDataFrame([(1, "v1", {"a": 1}, "own"), (2, None, {"b": 2}, "own"), (3, "v9", None, None)],
                                "r long, volume_id string, extra map<string,int>, fs string").withColumn("a.b", F.lit(1))
    vol = spark.createDataFrame([("v1", "ext4", "z")], "volume_id string, fs string, zone string")
    got = op.route_prepare(req, vol)
    assert sorted((r["r"], r["fs"], r["action"]) for r in got.collect()) == [(1, "ext4", "mount"), (2, None, "create"), (3, None, "reject")]
    assert sorted(r["r"] for r in op.refs_missing(req, vol, "volume_id").collect()) == [2, 3]
    latest = op.latest_entry(req.withColumn("g", F.lit(1)).select("g", "r", "extra"), ["g"], ["r"])
    assert [r["r"] for r in latest.collect()] == [3]
