"""Queries over damaged, repeated and unchanged copies and expiring streams, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablevault.functions import constants as K
from tablevault.operators.digests import digested_copy, sync_diff_digest
from tablevault.plans import catalog
from tablevault.plans import fixtures as fx
from tablevault.plans.fixtures import with_fixtures
from tablevault.session import new_work_dir
from tablevault.sources import fs
from tablevault.sources.salvage import row_groups, snapshot_salvage
from tablevault.sources.snapshot import read_snapshot, snapshot_full, sync_run
from tablevault.sources.tables import table
from tablevault.streaming import expiring_result, late_reports, wait_stream_expiring

GROUP_ROWS, FILE_ROWS = 500, 2000  # of the files that are damaged
TASK_FILES = 16  # of them that go to one task together
DIGEST_BUCKETS = 256
DELAY_MS, EXPIRY_S = 5 * 60_000, 6 * 3600


# ---------------------------------------------------------------- O3: row groups

def damaged_groups(spark: SparkSession, sf: str, dest: str) -> None:
    """``orders`` by ``o_orderkey % 3`` in files of ``FILE_ROWS`` rows in key order, row groups of
    ``GROUP_ROWS``; the second row group of every file of ``part=0`` is overwritten."""
    o = table(spark, sf, "orders").withColumn("part", F.pmod(F.col("o_orderkey"), F.lit(3)))
    # ranks by slices: the rows before a slice are counted, those in it are numbered
    dealt, order = f"{new_work_dir(spark, 'slices')}", ["part", "o_orderkey"]
    o.repartitionByRange(*order).withColumn("slice", F.spark_partition_id()).write.parquet(dealt)
    rows = spark.read.parquet(dealt)
    counts = rows.groupBy("part", "slice").agg(F.count("*").alias("n"))
    before = counts.select(F.col("part").alias("_part"), F.col("slice").alias("_slice"), (F.sum("n").over(
        Window.partitionBy("part").orderBy("slice")) - F.col("n")).alias("before"))
    ranked = rows.join(F.broadcast(before), F.col("part").eqNullSafe(F.col("_part")) & (F.col("slice") == F.col("_slice"))).withColumn(
        "rn", F.col("before") + F.row_number().over(Window.partitionBy("part", "slice").orderBy("o_orderkey")) - 1)
    # a task gets stretches of whole files; the last file of a folder may be short
    stretch = F.expr(f"rn div {FILE_ROWS * TASK_FILES}")
    (ranked.repartition("part", stretch).sortWithinPartitions("part", "rn").select(*o.columns).write.partitionBy("part")
     .option("maxRecordsPerFile", FILE_ROWS).option("parquet.block.row.count.limit", GROUP_ROWS).parquet(dest))
    groups = row_groups(spark, fs.list_files(spark, f"{dest}/part=0"))
    fs.overwrite_parts(spark, [(path, start, size) for path, k, _first, _rows, start, size in groups if k == 1], 0xFF)


def _salvaged(spark: SparkSession, sf: str, name: str) -> tuple[DataFrame, DataFrame]:
    work = new_work_dir(spark, name)
    damaged_groups(spark, sf, f"{work}/source")
    schema = catalog._with_part(table(spark, sf, "orders").schema)
    v, losses = snapshot_salvage(spark, f"{work}/source", f"{work}/target", schema=schema, drop_cols=("part",))
    return read_snapshot(spark, f"{work}/target", v), losses


def q_snapshot_salvage(spark, sf):
    return _salvaged(spark, sf, "snapshot_salvage")[0]


def q_salvage_losses(spark, sf):
    """Row groups lost, by folder and place in their file, and the rows in them."""
    losses = _salvaged(spark, sf, "salvage_losses")[1]
    part = F.regexp_extract("path", r"/part=(\d+)/", 1).cast("int")
    return losses.groupBy(part.alias("part"), "row_group", "first_row").agg(
        F.count("*").alias("files"), F.sum("lost").cast("long").alias("lost"), F.sum("copied").cast("long").alias("copied"))


_RANKED_SQL = """(select *, row_number() over (partition by o_orderkey % 3 order by o_orderkey) - 1 as rn from orders)"""
_LOST_SQL = f"o_orderkey % 3 = 0 and (rn % {FILE_ROWS}) // {GROUP_ROWS} = 1"


# ---------------------------------------------------------------- O4: digests

def q_sync_diff_digest(spark, sf):
    copy = f"{new_work_dir(spark, 'sync_diff_digest')}/copy"
    digested_copy(fx.target_orders(spark, sf), copy, catalog.SYNC_KEYS, catalog.SYNC_SIGNATURE, DIGEST_BUCKETS, repeats=True)
    return sync_diff_digest(table(spark, sf, "orders"), copy, catalog.SYNC_KEYS, catalog.SYNC_SIGNATURE, catalog.SYNC_PAYLOAD)


def nearly_equal(spark: SparkSession, sf: str) -> DataFrame:
    """``orders`` with a few prices changed, all in a few buckets of keys."""
    o = table(spark, sf, "orders")
    price = F.when(F.col("o_orderkey") % 5000 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return o.withColumn("o_totalprice", price)


def q_sync_diff_digest_few(spark, sf):
    """An older copy that differs in a handful of rows: few buckets are read."""
    copy = f"{new_work_dir(spark, 'sync_diff_digest_few')}/copy"
    digested_copy(nearly_equal(spark, sf), copy, catalog.SYNC_KEYS, catalog.SYNC_SIGNATURE, DIGEST_BUCKETS)
    return sync_diff_digest(table(spark, sf, "orders"), copy, catalog.SYNC_KEYS, catalog.SYNC_SIGNATURE, catalog.SYNC_PAYLOAD)


# ---------------------------------------------------------------- O5: repeated keys

def q_sync_run_repeated(spark, sf):
    """A target in which some keys stand twice, and two runs of the same sync."""
    target = new_work_dir(spark, "sync_run_repeated")
    old = fx.target_orders(spark, sf)
    snapshot_full(old.unionByName(old.where(F.col("o_orderkey") % 7 == 0)), target)
    for _ in range(2):
        v = sync_run(table(spark, sf, "orders"), target, catalog.SYNC_KEYS)
    return read_snapshot(spark, target, v)


# ---------------------------------------------------------------- O22: expiring state

def _expiring(spark: SparkSession, sf: str, name: str) -> tuple[SparkSession, str]:
    """Reports in four drops; every 11th is held back by one drop, so that most of those come late."""
    work = new_work_dir(spark, name)
    st = fx.instance_states(spark, sf)
    lo, hi = st.agg(F.min("event_id"), F.max("event_id")).first()
    lo, hi = lo or 0, hi or 0
    place = F.floor((F.col("event_id") - lo) * catalog.STREAM_DROPS / (hi - lo + 1))
    held = F.when(F.col("event_id") % 11 == 0, 1).otherwise(0)
    st = st.withColumn("arrival", F.least(place + held, F.lit(catalog.STREAM_DROPS - 1)).cast("long"))
    schema = catalog._with_part(st.schema)
    stream_spark = catalog._stream_session(spark)
    out = f"{work}/out"

    def run():
        src = stream_spark.readStream.schema(schema).parquet(f"{work}/in").drop("part", "arrival")
        wait_stream_expiring(src, "instance", "ts", "state", K.TERMINATED, out, f"{work}/checkpoint",
                             f"{DELAY_MS} milliseconds", EXPIRY_S).awaitTermination()

    catalog._drop_in_ranges(spark, st, "arrival", catalog.STREAM_DROPS, f"{work}/in", run)
    return stream_spark, out


def q_wait_stream_expiring(spark, sf):
    _, out = _expiring(spark, sf, "wait_stream_expiring")
    return expiring_result(spark, out, "instance").withColumns({
        c: F.col(c).cast("timestamp_ntz") for c in ("started", "reached_at")})


def q_wait_late_reports(spark, sf):
    """The reports behind the watermark when they arrived."""
    _, out = _expiring(spark, sf, "wait_late_reports")
    return late_reports(spark, out, "instance").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


_LATE_SQL = f"""
        select instance, s.ts, state
        from (select *, least(((event_id - lo) * {catalog.STREAM_DROPS} // (hi - lo + 1)) + (event_id % 11 = 0)::int,
                              {catalog.STREAM_DROPS - 1}) as arrival
              from instance_states, (select min(event_id) as lo, max(event_id) as hi from instance_states)) s
        join (select a.arrival, max(epoch_ms(b.ts)) - {DELAY_MS} as mark
              from (select unnest(range(1, {catalog.STREAM_DROPS})) as arrival) a
              join (select ts, least(((event_id - lo) * {catalog.STREAM_DROPS} // (hi - lo + 1)) + (event_id % 11 = 0)::int,
                                     {catalog.STREAM_DROPS - 1}) as arrival
                    from instance_states, (select min(event_id) as lo, max(event_id) as hi from instance_states)) b
              on b.arrival < a.arrival group by a.arrival) w using (arrival)
        where epoch_ms(s.ts) < mark"""

QUERIES = {
    "snapshot_salvage": q_snapshot_salvage,
    "snapshot_salvage_losses": q_salvage_losses,
    "sync_diff_digest": q_sync_diff_digest,
    "sync_diff_digest_few": q_sync_diff_digest_few,
    "sync_run_repeated": q_sync_run_repeated,
    "wait_stream_expiring": q_wait_stream_expiring,
    "wait_late_reports": q_wait_late_reports,
}

ORACLE_SQL = {
    "snapshot_salvage": f"select * exclude (rn) from {_RANKED_SQL} where not ({_LOST_SQL})",
    "snapshot_salvage_losses": f"""
        select 0::int as part, 1::int as row_group, {GROUP_ROWS}::bigint as first_row,
               count(distinct rn // {FILE_ROWS}) as files, count(*) as lost, 0::bigint as copied
        from {_RANKED_SQL} where {_LOST_SQL} having count(*) > 0""",
    "sync_diff_digest": with_fixtures(catalog._DIFF_SQL, "target_orders"),
    "sync_diff_digest_few": f"""
        with target_orders as (select * replace (case when o_orderkey % 5000 = 7 then o_totalprice + 1 else o_totalprice end as o_totalprice)
                               from orders)
        {catalog._DIFF_SQL}""",
    "sync_run_repeated": with_fixtures("""
        select * from orders
        union all
        select t.* from target_orders t, (values (1), (2)) v(k)
        where not exists (select 1 from orders s where s.o_orderkey = t.o_orderkey) and (k = 1 or t.o_orderkey % 7 = 0)""",
                                       "target_orders"),
    "wait_stream_expiring": with_fixtures(catalog._WAIT_SQL, "instance_states"),
    "wait_late_reports": with_fixtures(_LATE_SQL, "instance_states"),
}
