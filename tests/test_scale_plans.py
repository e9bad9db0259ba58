"""Plan-shape checks for the scale properties the operators promise."""

import pytest
from pyspark.sql import functions as F

from tablevault import operators as op


@pytest.fixture()
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.enabled"]
    old = {k: spark.conf.get(k) for k in keys}
    for k in keys[:2]:
        spark.conf.set(k, "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def _requests(spark, n=30000):
    # a third of the rows have no volume: one hot null key
    return spark.range(n).select(
        F.col("id").alias("request_id"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("vol-"), (F.col("id") % 50).cast("string")))
        .alias("volume_id"))


def _tasks_holding(df, cond):
    tagged = df.withColumn("_pid", F.spark_partition_id())
    return tagged.where(cond).select("_pid").distinct().count()


def test_rows_without_key_spread_over_tasks_in_anti_join(no_broadcast):
    spark = no_broadcast
    req = _requests(spark)
    vols = spark.createDataFrame([(f"vol-{i}",) for i in range(0, 50, 2)], "volume_id string")
    out = op.refs_missing(req, vols, "volume_id")
    assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert _tasks_holding(out, F.col("volume_id").isNull()) >= 4


def test_rows_without_key_spread_over_tasks_in_left_join(no_broadcast):
    spark = no_broadcast
    req = _requests(spark)
    vols = spark.createDataFrame([(f"vol-{i}",) for i in range(0, 50, 2)], "volume_id string")
    out = op.flag_existing(req, vols, "volume_id", "volume_id", "known")
    assert _tasks_holding(out, F.col("volume_id").isNull()) >= 4
    assert out.count() == req.count()


def test_hot_matched_request_key_is_split_by_aqe(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        # a third of the requests name the same, existing volume
        req = spark.range(300000).select(
            F.col("id").alias("request_id"),
            F.when(F.col("id") % 3 == 0, F.lit("vol-1"))
            .otherwise(F.concat(F.lit("vol-"), (F.col("id") % 5000).cast("string"))).alias("volume_id"))
        vols = spark.range(5000).select(F.concat(F.lit("vol-"), F.col("id").cast("string")).alias("volume_id"),
                                        F.lit("ext4").alias("fs"))
        for out in (op.refs_missing(req, vols, "volume_id"),
                    op.flag_existing(req, vols, "volume_id", "volume_id", "known"),
                    op.route_prepare(req, vols),
                    op.lookup_field(req, vols, "volume_id", ["fs"])):
            out.collect()
            assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_latest_entry_pre_aggregates_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), "id")
    plan = op.latest_entry(df, ["g"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_duplicate_check_adds_no_shuffle(no_broadcast):
    spark = no_broadcast
    s = spark.range(100).select(F.col("id").alias("k"), F.col("id").alias("sig"))
    plan = op.sync_diff(s, s, ["k"], ["sig"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def _scan_lines(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [ln for ln in plan.splitlines() if "FileScan parquet" in ln]


def test_scans_read_only_the_columns_they_need(spark):
    from tablevault.plans import catalog
    from tests.conftest import SF_SMALL

    (scan,) = _scan_lines(catalog.q_plan_size(spark, SF_SMALL))
    read_schema = scan.split("ReadSchema:")[1]
    assert "text" in read_schema and "source" in read_schema
    assert "doc_id" not in read_schema and "lang" not in read_schema and "n_chars" not in read_schema
    for scan in _scan_lines(catalog.q_run_outcome(spark, SF_SMALL)):
        read_schema = scan.split("ReadSchema:")[1]
        assert "l_extendedprice" not in read_schema and "l_shipdate" not in read_schema


def test_filters_reach_the_scan(spark):
    from tablevault.plans import catalog
    from tests.conftest import SF_SMALL

    scans = _scan_lines(catalog.q_new_entries(spark, SF_SMALL))
    assert any("PushedFilters: [IsNotNull(l_shipdate), LessThan(l_shipdate" in s for s in scans)


def test_null_keys_spread_in_sync_diff_and_sync_apply(no_broadcast):
    spark = no_broadcast
    src = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"),
                                    (F.col("id") % 7).alias("sig"))
    tgt = spark.range(15000, 45000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"), (F.col("id") % 5).alias("sig"))
    diff = op.sync_diff(src, tgt, ["k"], ["sig"])
    assert _tasks_holding(diff, F.col("k").isNull()) >= 4
    applied = op.sync_apply(src, tgt, ["k"])
    # all source rows, target-only rows, and null-key target rows beyond those equal to a source row
    s_null = [sum(1 for i in range(0, 30000, 3) if i % 7 == v) for v in range(5)]
    t_null = [sum(1 for i in range(15000, 45000, 3) if i % 5 == v) for v in range(5)]
    assert applied.count() == 30000 + 10000 + sum(max(0, t - s) for s, t in zip(s_null, t_null))


def test_sync_scans_read_keys_signature_and_payload_only(spark):
    import __spark_entry__ as E
    from tablevault.plans import catalog
    from tests.conftest import SF_SMALL

    for df in (catalog.q_sync_diff(spark, SF_SMALL), catalog.q_sync_report(spark, SF_SMALL), E.entry(spark)):
        scans = _scan_lines(df)
        assert scans and all("o_custkey" not in s.split("ReadSchema:")[1] for s in scans)
