"""Registered queries, one per operator, and their DuckDB oracle SQL.

Every query reads the driver tables (or fixtures Spark derives from them),
runs over whole tables and returns a DataFrame; no table data is collected. Column
names match the oracle SQL exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tablevault import operators as op
from tablevault.functions import constants as K
from tablevault.plans import fixtures as fx
from tablevault.plans.fixtures import with_fixtures
from tablevault.session import new_work_dir
from tablevault.sources import fs
from tablevault.sources.snapshot import (
    copy_steps,
    read_snapshot,
    read_tolerant,
    snapshot_full,
    snapshot_tolerant,
    sync_run,
)
from tablevault.sources.tables import file_listing, table, text_lines
from tablevault.streaming import read_synced, sync_stream, wait_stream, wait_stream_result

Query = Callable[[SparkSession, str], DataFrame]

# Query parameters shared by the Spark side and the oracle side.
SYNC_KEYS = ["o_orderkey"]
SYNC_SIGNATURE = ["o_totalprice", "o_orderdate"]
SYNC_PAYLOAD = ["o_orderstatus", "o_orderpriority"]
MATCH_PATTERNS = [r"^vol-", r"\tus-east-1[ab]\t"]
HREF_PATTERN = r'href="([^"]*)"'
ROUTE_PATTERNS = [("zone", K.ZONE_PATTERN, 0), ("instance", K.INSTANCE_ID_PATTERN, 1),
                  ("volume", K.VOLUME_ID_PATTERN, 0)]
STREAM_DROPS = 4
SYNC_BUCKETS = 16


def _with_part(schema: StructType) -> StructType:
    """A copy of ``schema`` plus the ``part`` folder column (``StructType.add``
    would change the DataFrame's own cached schema)."""
    return StructType(list(schema.fields) + [StructField("part", IntegerType(), True)])


def _receipt(run_col: str = "run_id"):
    return F.concat(F.lit("vol-"), (F.lit(10000000) + F.col(run_col)).cast("string"))


# ---------------------------------------------------------------- sync

def q_sync_diff(spark, sf):
    """The older copy repeats keys as soon as ``orders`` has keys past its shifted ones."""
    return op.sync_diff(table(spark, sf, "orders"), fx.target_orders(spark, sf), SYNC_KEYS,
                        SYNC_SIGNATURE, payload_cols=SYNC_PAYLOAD, target_repeats=True)


def q_sync_apply(spark, sf):
    return op.sync_apply(table(spark, sf, "orders"), fx.target_orders(spark, sf), SYNC_KEYS)


def q_sync_run(spark, sf):
    """Seed a versioned target with the older copy, sync ``orders`` into it
    and read the new version back."""
    target = new_work_dir(spark, "sync_run")
    snapshot_full(fx.target_orders(spark, sf), target)
    v = sync_run(table(spark, sf, "orders"), target, SYNC_KEYS)
    return read_snapshot(spark, target, v)


def q_sync_report(spark, sf):
    return op.sync_report(q_sync_diff(spark, sf))


def _drop_in_ranges(spark, df: DataFrame, col: str, parts: int, dest: str, after_each) -> None:
    """Write ``df`` as ``parts`` consecutive ranges of ``col`` into
    ``dest/part=k``, calling ``after_each()`` after each drop: new files
    arrive in ``col`` order, as a live feed would deliver them."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    if lo is None:  # empty input: one empty drop, so the stream has a folder to read
        df.write.mode("errorifexists").parquet(f"{dest}/part=0")
        after_each()
        return
    width = (hi - lo) // parts + 1
    for k in range(parts):
        a, b = lo + k * width, lo + (k + 1) * width
        here = (F.col(col) >= a) & (F.col(col) < b)
        if k == 0:  # rows without a value arrive first
            here = here | F.col(col).isNull()
        (df.where(here).write.mode("errorifexists")
         .parquet(f"{dest}/part={k}"))
        after_each()


def _stream_session(spark: SparkSession) -> SparkSession:
    """A session for a stream: the same context, with one shuffle (and state)
    partition per available core instead of a batch-sized default."""
    s = spark.newSession()
    s.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return s


def q_sync_stream(spark, sf):
    work = new_work_dir(spark, "sync_stream")
    ev = table(spark, sf, "events")
    schema = _with_part(ev.schema)
    target = f"{work}/target"
    stream_spark = _stream_session(spark)

    def run():
        src = stream_spark.readStream.schema(schema).parquet(f"{work}/in").drop("part")
        sync_stream(src, target, ["user_id"], "event_id", f"{work}/checkpoint",
                    buckets=SYNC_BUCKETS, keep_history=False).awaitTermination()

    _drop_in_ranges(spark, ev, "event_id", STREAM_DROPS, f"{work}/in", run)
    return read_synced(spark, target, SYNC_BUCKETS, schema=ev.schema).select(*ev.columns)


def q_sync_stream_seeded(spark, sf):
    """A target that holds the older copy already, and ``orders`` streamed in."""
    work = new_work_dir(spark, "sync_stream_seeded")
    target = f"{work}/target"
    snapshot_full(fx.target_orders(spark, sf), target)
    orders = table(spark, sf, "orders")
    schema = _with_part(orders.schema)
    stream_spark = _stream_session(spark)

    def run():
        src = stream_spark.readStream.schema(schema).parquet(f"{work}/in").drop("part")
        sync_stream(src, target, SYNC_KEYS, "o_orderdate", f"{work}/checkpoint",
                    buckets=SYNC_BUCKETS, keep_history=False).awaitTermination()

    _drop_in_ranges(spark, orders, "o_orderkey", 2, f"{work}/in", run)
    return read_synced(spark, target, SYNC_BUCKETS).select(*orders.columns)


# ------------------------------------------------------------ sizing

def q_plan_size(spark, sf):
    return op.plan_size(table(spark, sf, "documents"), ["source"], ["text"])


def q_plan_size_files(spark, sf):
    """The listing as text files in a folder per zone, sized by its files."""
    root = f"{new_work_dir(spark, 'plan_size_files')}/listing (by zone)"
    zone = F.coalesce(F.nullif(F.regexp_extract("line", r"\t(us-east-1[a-d])\t", 1), F.lit("")), F.lit("none"))
    fx.listing(spark, sf).select(F.col("line").alias("value"), zone.alias("zone")).write.partitionBy("zone").text(root)
    return op.plan_size_files(file_listing(spark, root), root).withColumn(
        "folder", F.regexp_replace("folder", "^zone=", ""))


def q_block_layout(spark, sf):
    return op.block_layout(table(spark, sf, "documents"), ["doc_id"], "text")


def q_block_split(spark, sf):
    b = op.block_split(table(spark, sf, "documents"), ["doc_id"], "text")
    return b.select("doc_id", "block_no", F.hex("block").alias("block_hex"))


def q_transfer_rate(spark, sf):
    return op.transfer_rate(fx.transfers(spark, sf), ["source"])


def q_transfer_records(spark, sf):
    recs = op.parse_records(fx.dd_log(spark, sf)).where(F.col("direction").isNotNull())
    return recs.groupBy("source", "direction").agg(
        F.sum("full_records").cast("long").alias("full_records"),
        F.sum("partial_records").cast("long").alias("partial_records"))


# ------------------------------------------------------------ listings

def q_match_lines(spark, sf):
    return op.match_lines(fx.listing(spark, sf), "line", MATCH_PATTERNS)


def q_match_lines_text(spark, sf):
    """The listing as plain text files (what a CLI dump looks like), read back
    with the text source and grepped."""
    path = f"{new_work_dir(spark, 'listing_text')}/listing"
    fx.listing(spark, sf).select("line").write.text(path)
    lines = text_lines(spark, path).select(F.col("value").alias("line"))
    return op.match_lines(lines, "line", MATCH_PATTERNS)


def q_extract_tokens(spark, sf):
    return op.extract_tokens(table(spark, sf, "pages"), ["page_id"], "html", HREF_PATTERN, 1)


def q_extract_ids(spark, sf):
    return op.extract_tokens(fx.listing(spark, sf), ["c_custkey"], "line",
                             K.INSTANCE_ID_PATTERN, K.INSTANCE_ID_GROUP)


def q_extract_zones(spark, sf):
    return op.extract_tokens(table(spark, sf, "pages"), ["page_id"], "html", K.ZONE_PATTERN, 0)


def q_extract_zones_listing(spark, sf):
    return op.extract_tokens(fx.listing(spark, sf), ["c_custkey"], "line", K.ZONE_PATTERN, 0)


def q_pick_fields(spark, sf):
    return op.pick_fields(fx.listing(spark, sf), "line", "\t",
                          fields={"volume": 1, "zone": 2, "size": 3, "instance": 4, "extra": 5},
                          chars={"head": (1, 4)}, keep=["c_custkey"])


def q_extract_named_value(spark, sf):
    return op.extract_named_value(table(spark, sf, "events"), ["event_id"], "props", "k",
                                  quoted=False)


def q_extract_state_name(spark, sf):
    return op.extract_named_value(fx.state_lines(spark, sf), ["event_id"], "line", "Name")


def q_lookup_field(spark, sf):
    req = fx.requests(spark, sf).select("request_id", "volume_id")
    return op.lookup_field(req, fx.volumes(spark, sf), "volume_id", ["zone", "fs"])


def q_lookup_field_text(spark, sf):
    """Grep the text listing for each worker's instance id and cut the zone
    field: ids are extracted from every line (O12), the field is cut (O13)
    and the lookup is an equi-join (O15)."""
    lines = fx.listing(spark, sf)
    ids = op.extract_tokens(lines, ["line"], "line", K.INSTANCE_ID_PATTERN, K.INSTANCE_ID_GROUP)
    by_id = op.pick_fields(ids, "line", "\t", fields={"zone": 2}, keep=["token"]) \
        .withColumnRenamed("token", "instance_id")
    workers = fx.workers(spark, sf).select("source_id", "instance_id")
    return op.lookup_field(workers, by_id, "instance_id", ["zone"])


# -------------------------------------------------------------- guards

def q_refs_present(spark, sf):
    req = fx.requests(spark, sf).where(F.col("volume_id").isNotNull())
    return op.refs_present(req, fx.volumes(spark, sf), "volume_id")


def q_refs_missing(spark, sf):
    req = fx.requests(spark, sf).where(F.col("volume_id").isNotNull())
    return op.refs_missing(req, fx.volumes(spark, sf), "volume_id")


def q_validate_requests(spark, sf):
    return op.validate_requests(fx.requests(spark, sf), fx.volumes(spark, sf), fx.sources(spark, sf))


def q_placement_conflicts(spark, sf):
    return op.placement_conflicts(fx.requests(spark, sf), fx.volumes(spark, sf), fx.workers(spark, sf))


# ----------------------------------------------------------- lifecycle

def q_latest_entry(spark, sf):
    dev = fx.devices(spark, sf).where(F.col("snapshot") == 2)
    return op.latest_entry(dev, ["host"], ["minor"])


def q_latest_event(spark, sf):
    return op.latest_entry(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"])


def q_new_entries(spark, sf):
    dev = fx.devices(spark, sf)
    after = dev.where(F.col("snapshot") == 2).select("host", "minor")
    before = dev.where(F.col("snapshot") == 1).select("host", "minor")
    return op.new_entries(after, before)


def q_new_entries_repeated(spark, sf):
    dev = fx.device_rows(spark, sf)
    after = dev.where(F.col("snapshot") == 2).select("host", "minor")
    before = dev.where(F.col("snapshot") == 1).select("host", "minor")
    return op.new_entries(after, before)


def q_wait_profile(spark, sf):
    return op.wait_profile(fx.instance_states(spark, sf), "instance", "ts", "state", K.TERMINATED)


def q_wait_stream(spark, sf):
    work = new_work_dir(spark, "wait_stream")
    st = fx.instance_states(spark, sf)
    schema = _with_part(st.schema)
    out = f"{work}/updates"
    stream_spark = _stream_session(spark)

    def run():
        src = stream_spark.readStream.schema(schema).parquet(f"{work}/in").drop("part")
        wait_stream(src, "instance", "ts", "state", K.TERMINATED, out,
                    f"{work}/checkpoint").awaitTermination()

    _drop_in_ranges(spark, st, "event_id", STREAM_DROPS, f"{work}/in", run)
    return wait_stream_result(spark, out, "instance")


def q_wait_stream_late(spark, sf):
    """The same reports arriving far out of time order, with nothing kept between batches."""
    work = new_work_dir(spark, "wait_stream_late")
    st = fx.instance_states(spark, sf).withColumn("arrival", F.pmod(F.col("event_id") * 7919, F.lit(10007)))
    schema = _with_part(st.schema)
    out = f"{work}/updates"
    stream_spark = _stream_session(spark)

    def run():
        src = stream_spark.readStream.schema(schema).parquet(f"{work}/in").drop("part", "arrival")
        wait_stream(src, "instance", "ts", "state", K.TERMINATED, out, f"{work}/checkpoint", keep_state=False,
                    compact_every=3).awaitTermination()

    _drop_in_ranges(spark, st, "arrival", STREAM_DROPS, f"{work}/in", run)
    return wait_stream_result(spark, out, "instance")


def q_route_plan(spark, sf):
    return op.route_plan(fx.requests(spark, sf))


def q_route_prepare(spark, sf):
    return op.route_prepare(fx.requests(spark, sf), fx.volumes(spark, sf))


def q_route_state(spark, sf):
    return op.route_state(fx.instance_states(spark, sf).select("event_id", "instance", "state"))


def q_route_pattern(spark, sf):
    return op.first_pattern(fx.listing(spark, sf), "line", ROUTE_PATTERNS, keep=["c_custkey"])


def q_run_outcome(spark, sf):
    return op.run_outcome(fx.steps(spark, sf), receipt=_receipt())


def q_cleanup_plan(spark, sf):
    return op.cleanup_plan(fx.ledger(spark, sf))


# ------------------------------------------------------------ snapshots (O2, O3)

def q_snapshot_full(spark, sf):
    target = new_work_dir(spark, "snapshot_full")
    v = snapshot_full(table(spark, sf, "orders"), target, codec="zstd")
    return read_snapshot(spark, target, v)


def damaged_copy(spark, sf, dest: str) -> None:
    """``orders`` split by ``o_orderkey % 3`` into three folders; every file of
    folder ``part=0`` is then overwritten with bytes that are not parquet."""
    o = table(spark, sf, "orders")
    o.withColumn("part", F.pmod(F.col("o_orderkey"), F.lit(3))).write.partitionBy("part").parquet(dest)
    for f in fs.list_files(spark, f"{dest}/part=0"):
        fs.overwrite_bytes(spark, f, b"garbage-not-parquet")


def q_snapshot_tolerant(spark, sf):
    work = new_work_dir(spark, "snapshot_tolerant")
    damaged_copy(spark, sf, f"{work}/source")
    schema = _with_part(table(spark, sf, "orders").schema)
    v, _skipped = snapshot_tolerant(spark, f"{work}/source", f"{work}/target", schema=schema,
                                    drop_cols=("part",))
    return read_snapshot(spark, f"{work}/target", v)


def q_snapshot_skipped(spark, sf):
    """Per source folder of the damaged copy: did the tolerant read skip any
    of its files? (File names depend on the writer; the folders do not.)"""
    work = new_work_dir(spark, "snapshot_skipped")
    src = f"{work}/source"
    damaged_copy(spark, sf, src)
    schema = _with_part(table(spark, sf, "orders").schema)
    _rows, skipped = read_tolerant(spark, src, schema)
    flagged = (file_listing(spark, src).select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"))
               .join(skipped.select("path", F.lit(True).alias("hit")), on="path", how="left"))
    folder = F.regexp_extract(F.col("path"), r"/part=(\d+)/", 1).cast("int")
    return flagged.groupBy(folder.alias("part")).agg(
        F.max(F.coalesce(F.col("hit"), F.lit(False))).alias("skipped"))


def q_snapshot_partial(spark, sf):
    """``orders`` in three folders; in one of them data pages are damaged, the footers
    are whole. Rows by folder that were copied or reported lost, whether any were
    lost, and how a run that copies this folder ends."""
    work = new_work_dir(spark, "snapshot_partial")
    src = f"{work}/source 100%"
    o = table(spark, sf, "orders")
    o.withColumn("part", F.pmod(F.col("o_orderkey"), F.lit(3))).write.partitionBy("part").parquet(src)
    for f in fs.list_files(spark, f"{src}/part=0"):
        data = fs.read_bytes(spark, f)
        fs.overwrite_bytes(spark, f, data[:4] + bytes(max(0, len(data) // 2 - 4)) + data[len(data) // 2:])
    v, skipped = snapshot_tolerant(spark, src, f"{work}/target", schema=_with_part(o.schema))
    folder = F.regexp_extract(F.col("path"), r"/part=(\d+)/", 1).cast("int")
    copied = read_snapshot(spark, f"{work}/target", v).groupBy("part").agg(F.count("*").alias("n"))
    lost = skipped.groupBy(folder.alias("part")).agg(F.sum("lost").alias("n"))
    rows = copied.unionByName(lost).groupBy("part").agg(F.sum("n").cast("long").alias("rows"))
    files = file_listing(spark, src).select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"))
    ends = op.run_outcome(copy_steps(skipped, files, folder)).select(F.col("run_id").alias("part"), "exit_code")
    return rows.join(ends, "part").select("part", "rows", (F.col("exit_code") > 0).alias("damaged"), "exit_code")


QUERIES: dict[str, Query] = {
    "plan_size": q_plan_size,
    "snapshot_full": q_snapshot_full,
    "snapshot_tolerant": q_snapshot_tolerant,
    "snapshot_skipped": q_snapshot_skipped,
    "snapshot_partial": q_snapshot_partial,
    "sync_diff": q_sync_diff,
    "sync_apply": q_sync_apply,
    "sync_report": q_sync_report,
    "sync_run": q_sync_run,
    "sync_stream": q_sync_stream,
    "sync_stream_seeded": q_sync_stream_seeded,
    "block_layout": q_block_layout,
    "block_split": q_block_split,
    "transfer_rate": q_transfer_rate,
    "transfer_records": q_transfer_records,
    "match_lines": q_match_lines,
    "match_lines_text": q_match_lines_text,
    "extract_tokens": q_extract_tokens,
    "extract_ids": q_extract_ids,
    "extract_zones": q_extract_zones,
    "extract_zones_listing": q_extract_zones_listing,
    "extract_state_name": q_extract_state_name,
    "plan_size_files": q_plan_size_files,
    "new_entries_repeated": q_new_entries_repeated,
    "pick_fields": q_pick_fields,
    "extract_named_value": q_extract_named_value,
    "lookup_field": q_lookup_field,
    "lookup_field_text": q_lookup_field_text,
    "refs_present": q_refs_present,
    "refs_missing": q_refs_missing,
    "validate_requests": q_validate_requests,
    "placement_conflicts": q_placement_conflicts,
    "latest_entry": q_latest_entry,
    "latest_event": q_latest_event,
    "new_entries": q_new_entries,
    "wait_profile": q_wait_profile,
    "wait_stream": q_wait_stream,
    "wait_stream_late": q_wait_stream_late,
    "route_plan": q_route_plan,
    "route_prepare": q_route_prepare,
    "route_state": q_route_state,
    "route_pattern": q_route_pattern,
    "run_outcome": q_run_outcome,
    "cleanup_plan": q_cleanup_plan,
}


# ------------------------------------------------------------------ oracle SQL

def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _method_sql(c: str = "method") -> str:
    return f"coalesce(nullif({c}, ''), {_sql_str(K.DEFAULT_METHOD)})"


_DIFF_SQL = f"""
select coalesce(s.o_orderkey, t.o_orderkey) as o_orderkey,
       case when t.o_orderkey is null then 'new'
            when s.o_orderkey is null then 'target_only'
            when s.o_totalprice is not distinct from t.o_totalprice
             and s.o_orderdate is not distinct from t.o_orderdate then 'unchanged'
            else 'changed' end as cls,
       cast(case when s.o_orderkey is not null
                 then coalesce(strlen(s.o_orderstatus), 0) + coalesce(strlen(s.o_orderpriority), 0)
                 else coalesce(strlen(t.o_orderstatus), 0) + coalesce(strlen(t.o_orderpriority), 0)
            end as bigint) as bytes
from orders s full outer join target_orders t on s.o_orderkey = t.o_orderkey
"""

_WAIT_SQL = """
select {key}, started, reached_at,
       cast(us as double) / 1000000.0 as wait_s,
       polls, polls * {p} as slept_s, (polls + 1) * {p} as reported_s,
       reached_at is not null as reached
from (
  select *, case when reached_at is null then null when us <= 0 then 0
                 else (us + {step} - 1) // {step} + 1 end as polls
  from (
    select {key}, started, reached_at, epoch_us(reached_at) - epoch_us(started) as us
    from (select {key}, min(ts) as started,
                 min(case when state = '{target}' then ts end) as reached_at
          from instance_states group by {key})))
""".format(key="instance", p=K.POLL_INTERVAL_S, step=K.POLL_INTERVAL_S * 1_000_000,
           target=K.TERMINATED)


def _route_pattern_sql() -> str:
    names = " ".join(f"when regexp_matches(line, {_sql_str(p)}) then {_sql_str(n)}"
                     for n, p, _g in ROUTE_PATTERNS)
    values = " ".join(f"when regexp_matches(line, {_sql_str(p)}) then regexp_extract(line, {_sql_str(p)}, {g})"
                      for _n, p, g in ROUTE_PATTERNS)
    return f"select c_custkey, case {names} end as pattern, case {values} end as value from listing"


def _cut(n: int, c: str = "line") -> str:
    return f"case when strpos({c}, chr(9)) = 0 then {c} else split_part({c}, chr(9), {n}) end"


def _plan_sql() -> str:
    m = _method_sql()
    has = "coalesce(volume_id, '') <> ''"
    whens = " ".join(
        f"when {m} = {_sql_str(meth)} and {'' if with_vol else 'not '}({has}) then {_sql_str(letter)}"
        for meth, with_vol, letter in K.PLAN_RULES)
    return f"select request_id, method, volume_id, source_id, case {whens} end as plan from requests"


ORACLE_SQL: dict[str, str] = {
    "plan_size": f"""
        select source, bytes, (bytes + 1023) // 1024 as kib,
               ((bytes + 1023) // 1024 * {K.SIZE_FACTOR}) // {K.KIB_PER_GIB} + {K.SIZE_HEADROOM_GIB} as gib
        from (select source, cast(coalesce(sum(coalesce(strlen(text), 0)), 0) as bigint) as bytes
              from documents group by source)""",
    "snapshot_full": "select * from orders",
    "snapshot_tolerant": "select * from orders where o_orderkey % 3 <> 0",
    "snapshot_skipped": """
        select cast(o_orderkey % 3 as int) as part, bool_or(o_orderkey % 3 = 0) as skipped
        from orders group by 1""",
    "snapshot_partial": """
        select cast(o_orderkey % 3 as int) as part, count(*) as rows, bool_or(o_orderkey % 3 = 0) as damaged,
               cast(max(case when o_orderkey % 3 = 0 then 1 else 0 end) as int) as exit_code
        from orders group by 1""",
    "sync_diff": with_fixtures(_DIFF_SQL, "target_orders"),
    "sync_apply": with_fixtures("""
        select * from orders
        union all
        select * from target_orders t
        where not exists (select 1 from orders s where s.o_orderkey = t.o_orderkey)""",
                                "target_orders"),
    "sync_run": with_fixtures("""
        select * from orders
        union all
        select * from target_orders t
        where not exists (select 1 from orders s where s.o_orderkey = t.o_orderkey)""",
                              "target_orders"),
    "sync_report": with_fixtures(f"""
        select cls, count(*) as rows, cast(coalesce(sum(bytes), 0) as bigint) as bytes
        from ({_DIFF_SQL}) d group by cls""", "target_orders"),
    "sync_stream_seeded": with_fixtures("""
        select * from orders
        union all
        select * from target_orders t
        where not exists (select 1 from orders s where s.o_orderkey = t.o_orderkey)""",
                                        "target_orders"),
    "sync_stream": """
        select * from events
        qualify row_number() over (partition by user_id order by event_id desc) = 1""",
    "block_layout": f"""
        select doc_id, bytes, bytes // {K.BLOCK_SIZE} as full_blocks,
               case when bytes % {K.BLOCK_SIZE} > 0 then 1 else 0 end as partial_blocks,
               (bytes // {K.BLOCK_SIZE} + case when bytes % {K.BLOCK_SIZE} > 0 then 1 else 0 end)
                 * {K.BLOCK_SIZE} as padded_bytes
        from (select doc_id, cast(coalesce(strlen(text), 0) as bigint) as bytes from documents)""",
    "block_split": f"""
        select doc_id, cast(b as int) as block_no,
               rpad(substr(h, b * {2 * K.BLOCK_SIZE} + 1, {2 * K.BLOCK_SIZE}), {2 * K.BLOCK_SIZE}, '0')
                 as block_hex
        from (select doc_id, h, unnest(range(0, (n + {K.BLOCK_SIZE - 1}) // {K.BLOCK_SIZE})) as b
              from (select doc_id, hex(encode(text)) as h, strlen(text) as n
                    from documents where strlen(text) > 0))""",
    "transfer_rate": with_fixtures(f"""
        select source, cast(sum(bytes) as bigint) as bytes, sum(seconds) as seconds,
               case when sum(seconds) = 0 then null
                    else (cast(sum(bytes) as bigint) / {K.BYTES_PER_MB}) / sum(seconds) end as mb_per_s
        from (select source,
                     try_cast(regexp_extract(line, '(\\d+) bytes', 1) as bigint) as bytes,
                     try_cast(regexp_extract(line, 'copied, ([0-9]+(?:\\.[0-9]+)?) s', 1) as double) as seconds
              from transfers)
        where bytes is not null group by source""", "transfers"),
    "transfer_records": " union all ".join(f"""
        select source, '{d}' as direction,
               cast(sum(strlen(text) // {K.BLOCK_SIZE}) as bigint) as full_records,
               cast(sum(case when strlen(text) % {K.BLOCK_SIZE} > 0 then 1 else 0 end) as bigint)
                 as partial_records
        from documents where text is not null group by source""" for d in ("in", "out")),
    "match_lines": with_fixtures(
        "select c_custkey, line from listing where "
        + " and ".join(f"regexp_matches(line, {_sql_str(p)})" for p in MATCH_PATTERNS), "listing"),
    "match_lines_text": with_fixtures(
        "select line from listing where "
        + " and ".join(f"regexp_matches(line, {_sql_str(p)})" for p in MATCH_PATTERNS), "listing"),
    "extract_tokens": f"""
        select page_id, cast(unnest(range(0, len(l))) as int) as pos, unnest(l) as token
        from (select page_id, regexp_extract_all(html, {_sql_str(HREF_PATTERN)}, 1) as l from pages)""",
    "extract_ids": with_fixtures(f"""
        select c_custkey, cast(unnest(range(0, len(l))) as int) as pos, unnest(l) as token
        from (select c_custkey, regexp_extract_all(line, {_sql_str(K.INSTANCE_ID_PATTERN)},
                                                   {K.INSTANCE_ID_GROUP}) as l from listing)""",
                                 "listing"),
    "extract_zones": f"""
        select page_id, cast(unnest(range(0, len(l))) as int) as pos, unnest(l) as token
        from (select page_id, regexp_extract_all(html, {_sql_str(K.ZONE_PATTERN)}, 0) as l from pages)""",
    "extract_zones_listing": with_fixtures(f"""
        select c_custkey, cast(unnest(range(0, len(l))) as int) as pos, unnest(l) as token
        from (select c_custkey, regexp_extract_all(line, {_sql_str(K.ZONE_PATTERN)}, 0) as l from listing)""", "listing"),
    "extract_state_name": with_fixtures("""
        select event_id, regexp_extract(line, '"Name": "(\\w+)"', 1) as value
        from state_lines where regexp_matches(line, '"Name": "\\w+"')""", "state_lines"),
    "plan_size_files": with_fixtures(f"""
        select folder, bytes, (bytes + 1023) // 1024 as kib,
               ((bytes + 1023) // 1024 * {K.SIZE_FACTOR}) // {K.KIB_PER_GIB} + {K.SIZE_HEADROOM_GIB} as gib
        from (select coalesce(nullif(regexp_extract(line, '\\t(us-east-1[a-d])\\t', 1), ''), 'none') as folder,
                     cast(sum(strlen(line) + 1) as bigint) as bytes
              from listing group by 1)""", "listing"),
    "new_entries_repeated": with_fixtures("""
        select host, minor from device_rows where snapshot = 2
        except
        select host, minor from device_rows where snapshot = 1""", "device_rows"),
    "pick_fields": with_fixtures(f"""
        select c_custkey, {_cut(1)} as volume, {_cut(2)} as zone, {_cut(3)} as size,
               {_cut(4)} as instance, {_cut(5)} as extra, substr(line, 1, 4) as head
        from listing""", "listing"),
    "extract_named_value": """
        select event_id, regexp_extract(props, '"k": (\\w+)', 1) as value
        from events where regexp_matches(props, '"k": (\\w+)')""",
    "lookup_field": with_fixtures("""
        select r.volume_id, r.request_id, v.zone, v.fs
        from requests r join volumes v on r.volume_id = v.volume_id""", "requests", "volumes"),
    "lookup_field_text": with_fixtures(f"""
        select w.instance_id, w.source_id, {_cut(2, "ids.line")} as zone
        from workers w join (
          select line, unnest(regexp_extract_all(line, {_sql_str(K.INSTANCE_ID_PATTERN)},
                                                 {K.INSTANCE_ID_GROUP})) as instance_id
          from listing) ids on w.instance_id = ids.instance_id""", "listing", "workers"),
    "refs_present": with_fixtures("""
        select * from requests r where r.volume_id is not null
          and exists (select 1 from volumes v where v.volume_id = r.volume_id and v.volume_id <> '')""",
                                  "requests", "volumes"),
    "refs_missing": with_fixtures("""
        select * from requests r where r.volume_id is not null
          and not exists (select 1 from volumes v where v.volume_id = r.volume_id and v.volume_id <> '')""",
                                  "requests", "volumes"),
    "validate_requests": with_fixtures(f"""
        select r.request_id, r.volume_id, r.source_id, {_method_sql('r.method')} as method,
               case when {_method_sql('r.method')} not in ('dd', 'rsync') then 'bad_method'
                    when r.volume_id = '' then 'volume_blank'
                    when r.volume_id is not null
                     and not exists (select 1 from volumes v where v.volume_id = r.volume_id)
                      then 'volume_unknown'
                    when r.source_id is null then 'source_missing'
                    when not exists (select 1 from sources s where s.source_id = r.source_id)
                      then 'source_unknown'
                    else 'ok' end as verdict
        from requests r""", "requests", "volumes", "sources"),
    "placement_conflicts": with_fixtures("""
        select r.request_id, r.volume_id, w.instance_id, v.zone as volume_zone, w.zone as instance_zone
        from requests r join volumes v on r.volume_id = v.volume_id
             join workers w on r.source_id = w.source_id
        where coalesce(r.volume_id, '') <> '' and coalesce(v.zone, '') <> coalesce(w.zone, '')""",
                                         "requests", "volumes", "workers"),
    "latest_entry": with_fixtures("""
        select host, max(minor) as minor, 2 as snapshot from devices where snapshot = 2 group by host""",
                                  "devices"),
    "latest_event": """
        select * from events
        qualify row_number() over (partition by user_id order by ts desc, event_id desc,
                                   event_type desc, value desc, props desc) = 1""",
    "new_entries": with_fixtures("""
        select host, minor from devices where snapshot = 2
        except
        select host, minor from devices where snapshot = 1""", "devices"),
    "wait_profile": with_fixtures(_WAIT_SQL, "instance_states"),
    "wait_stream": with_fixtures(_WAIT_SQL, "instance_states"),
    "wait_stream_late": with_fixtures(_WAIT_SQL, "instance_states"),
    "route_plan": with_fixtures(_plan_sql(), "requests"),
    "route_prepare": with_fixtures(f"""
        select r.request_id, r.method, r.volume_id, r.source_id, v.fs,
               case when coalesce(r.volume_id, '') = '' then 'create'
                    when v.volume_id is null then 'reject'
                    when v.fs = '{K.RAW_CONTENT}' then 'format_mount'
                    when v.fs in ({", ".join(_sql_str(f) for f in K.SUPPORTED_FILESYSTEMS)}) then 'mount'
                    else 'rollback' end as action
        from requests r left join (select volume_id, min(fs) as fs from volumes
                                   where coalesce(volume_id, '') <> '' group by volume_id) v
          on r.volume_id = v.volume_id""", "requests", "volumes"),
    "route_state": with_fixtures(
        "select event_id, instance, state, case "
        + " ".join(f"when state = {_sql_str(s)} then {_sql_str(a)}" for s, a in K.STATE_ACTIONS)
        + " end as action from instance_states", "instance_states"),
    "route_pattern": with_fixtures(_route_pattern_sql(), "listing"),
    "run_outcome": with_fixtures("""
        select run_id, cast(max(case when rc <> 0 then 1 else 0 end) as int) as exit_code,
               min(case when rc <> 0 then step_no end) as failed_step, count(*) as steps,
               case when max(case when rc <> 0 then 1 else 0 end) = 0
                    then concat('vol-', cast(10000000 + run_id as varchar)) end as receipt
        from steps group by run_id""", "steps"),
    "cleanup_plan": with_fixtures("""
        select run_id, cast(row_number() over (partition by run_id order by kind_order, kind) as int)
                 as step_no, kind
        from (select run_id, kind, min(kind_order) as kind_order from ledger
              where created_here and kind <> 'volume' group by run_id, kind)""", "ledger"),
}


def queries() -> dict[str, Query]:
    return QUERIES | _further("QUERIES")


def oracle_sql() -> dict[str, str]:
    found = ORACLE_SQL | _further("ORACLE_SQL")
    return {k: v.strip() for k, v in found.items() if k in queries()}


def _further(name: str) -> dict:
    """The queries of the other modules of this folder, which build on this one."""
    from tablevault.plans import listings_more, recovery

    return getattr(recovery, name) | getattr(listings_more, name)
