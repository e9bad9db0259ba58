"""Inputs derived from the driver tables.

Each fixture is built twice from the same definition: as a DataFrame (what
the Spark queries read) and as SQL text (a CTE for the DuckDB oracle). All
of them grow with the tables they come from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablevault.functions import constants as K
from tablevault.sources.tables import table

TAB = "\t"


def _zone_from(nation_key: str):
    # us-east-1a .. us-east-1d, picked by nation key
    return F.concat(F.lit("us-east-1"),
                    F.lit("abcd").substr((F.col(nation_key) % 4 + 1).cast("int"), F.lit(1)))


def target_orders(spark: SparkSession, sf: str) -> DataFrame:
    """An older copy of ``orders``: a quarter missing, every tenth price off by
    one, and some rows that exist only here."""
    o = table(spark, sf, "orders")
    kept = o.where(F.col("o_orderkey") % 4 != 0).select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.when(F.col("o_orderkey") % 10 == 0, F.col("o_totalprice") + 1)
        .otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate", "o_orderpriority")
    only_here = o.where(F.col("o_orderkey") % 50 == 0).select(
        (F.col("o_orderkey") + 1000000).alias("o_orderkey"), "o_custkey", "o_orderstatus",
        "o_totalprice", "o_orderdate", "o_orderpriority")
    return kept.unionByName(only_here)


TARGET_ORDERS_SQL = """
select o_orderkey, o_custkey, o_orderstatus,
       case when o_orderkey % 10 = 0 then o_totalprice + 1 else o_totalprice end as o_totalprice,
       o_orderdate, o_orderpriority
from orders where o_orderkey % 4 <> 0
union all
select o_orderkey + 1000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
from orders where o_orderkey % 50 = 0
"""


def listing(spark: SparkSession, sf: str) -> DataFrame:
    """One text line per instance: volume id, zone, size and the quoted
    instance id, tab-separated; every tenth line has no tabs."""
    c = table(spark, sf, "customer")
    vol = F.concat(F.lit("vol-"), (F.lit(10000000) + F.col("c_custkey")).cast("string"))
    full = F.concat(vol, F.lit(TAB), _zone_from("c_nationkey"), F.lit(TAB),
                    F.lit("size="), F.col("c_nationkey").cast("string"), F.lit(TAB),
                    F.lit('"i-'), (F.lit(20000000) + F.col("c_custkey")).cast("string"), F.lit('"'))
    return c.select("c_custkey",
                    F.when(F.col("c_custkey") % 10 == 0, vol).otherwise(full).alias("line"))


LISTING_SQL = """
select c_custkey,
       case when c_custkey % 10 = 0 then concat('vol-', cast(10000000 + c_custkey as varchar))
       else concat('vol-', cast(10000000 + c_custkey as varchar), chr(9),
                   'us-east-1', substr('abcd', cast(c_nationkey % 4 + 1 as int), 1), chr(9),
                   'size=', cast(c_nationkey as varchar), chr(9),
                   '"i-', cast(20000000 + c_custkey as varchar), '"') end as line
from customer
"""


def volumes(spark: SparkSession, sf: str) -> DataFrame:
    """The volume inventory: id, zone and what a probe finds on it."""
    s = table(spark, sf, "supplier")
    fs = (F.when(F.col("s_suppkey") % 3 == 0, F.lit(K.RAW_CONTENT))
          .when(F.col("s_suppkey") % 3 == 1, F.lit("ext4")).otherwise(F.lit("xfs")))
    return s.select(F.concat(F.lit("vol-"), (F.lit(10000000) + F.col("s_suppkey")).cast("string"))
                    .alias("volume_id"),
                    _zone_from("s_nationkey").alias("zone"), fs.alias("fs"))


VOLUMES_SQL = """
select concat('vol-', cast(10000000 + s_suppkey as varchar)) as volume_id,
       concat('us-east-1', substr('abcd', cast(s_nationkey % 4 + 1 as int), 1)) as zone,
       case s_suppkey % 3 when 0 then 'data' when 1 then 'ext4' else 'xfs' end as fs
from supplier
"""


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Copy requests with every kind of fault: bad or blank methods, no
    volume (a third of them), blank and unknown volumes, missing and unknown
    sources."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    method = (F.when(k % 5 == 0, F.lit("dd")).when(k % 5 == 1, F.lit("rsync"))
              .when(k % 5 == 2, F.lit("")).when(k % 5 == 3, F.lit(None).cast("string"))
              .otherwise(F.lit("tar")))
    volume = (F.when(k % 3 == 0, F.lit(None).cast("string")).when(k % 13 == 0, F.lit(""))
              .otherwise(F.concat(F.lit("vol-"), (F.lit(10000000) + k % 150).cast("string"))))
    source = (F.when(k % 17 == 0, F.lit(None).cast("long"))
              .otherwise(F.col("o_custkey") + F.when(k % 19 == 0, F.lit(1000000)).otherwise(F.lit(0))))
    return o.select(k.alias("request_id"), method.alias("method"), volume.alias("volume_id"),
                    source.alias("source_id"))


REQUESTS_SQL = """
select o_orderkey as request_id,
       case o_orderkey % 5 when 0 then 'dd' when 1 then 'rsync' when 2 then '' when 3 then null else 'tar' end as method,
       case when o_orderkey % 3 = 0 then null when o_orderkey % 13 = 0 then ''
            else concat('vol-', cast(10000000 + o_orderkey % 150 as varchar)) end as volume_id,
       case when o_orderkey % 17 = 0 then null
            else o_custkey + case when o_orderkey % 19 = 0 then 1000000 else 0 end end as source_id
from orders
"""


def sources(spark: SparkSession, sf: str) -> DataFrame:
    """Known source hosts (one per customer)."""
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("source_id"))


SOURCES_SQL = "select c_custkey as source_id from customer"


def workers(spark: SparkSession, sf: str) -> DataFrame:
    """The instance that serves each source host, with its zone (same zone
    rule as the listing)."""
    c = table(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("source_id"),
                    F.concat(F.lit("i-"), (F.lit(20000000) + F.col("c_custkey")).cast("string"))
                    .alias("instance_id"),
                    _zone_from("c_nationkey").alias("zone"))


WORKERS_SQL = """
select c_custkey as source_id, concat('i-', cast(20000000 + c_custkey as varchar)) as instance_id,
       concat('us-east-1', substr('abcd', cast(c_nationkey % 4 + 1 as int), 1)) as zone
from customer
"""


def steps(spark: SparkSession, sf: str) -> DataFrame:
    """Return code of each step of each run."""
    li = table(spark, sf, "lineitem")
    return li.groupBy(F.col("l_orderkey").alias("run_id"), F.col("l_linenumber").alias("step_no")).agg(
        F.min(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("rc"))


STEPS_SQL = """
select l_orderkey as run_id, l_linenumber as step_no,
       min(case when l_returnflag = 'R' then 1 else 0 end) as rc
from lineitem group by l_orderkey, l_linenumber
"""


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    """What each run touched and whether the run created it (four kinds per
    run, generated per row, no join)."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    x = o.select(k.alias("run_id"), F.explode(F.array(*[F.lit(n) for n in K.CLEANUP_ORDER])).alias("kind"))
    kind = F.col("kind")
    run = F.col("run_id")
    order = (F.when(kind == "instance", 1).when(kind == "group", 2).when(kind == "key", 3)
             .otherwise(4))
    created = (F.when(kind == "instance", F.lit(True)).when(kind == "group", run % 3 != 0)
               .when(kind == "key", run % 2 == 0).otherwise(run % 5 == 0))
    return x.select("run_id", "kind", order.alias("kind_order"), created.alias("created_here"))


LEDGER_SQL = """
select run_id, kind,
       case kind when 'instance' then 1 when 'group' then 2 when 'key' then 3 else 4 end as kind_order,
       case kind when 'instance' then true when 'group' then run_id % 3 <> 0
                 when 'key' then run_id % 2 = 0 else run_id % 5 = 0 end as created_here
from (select o_orderkey as run_id, unnest(['instance', 'group', 'key', 'volume']) as kind from orders)
"""


def devices(spark: SparkSession, sf: str) -> DataFrame:
    """Device rows in two listings; listing 1 is the earlier one and is
    contained in listing 2."""
    li = table(spark, sf, "lineitem")
    later = li.select(F.col("l_orderkey").alias("host"), F.col("l_linenumber").alias("minor")) \
        .distinct().withColumn("snapshot", F.lit(2))
    earlier = li.where(F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp_ntz")) \
        .select(F.col("l_orderkey").alias("host"), F.col("l_linenumber").alias("minor")) \
        .distinct().withColumn("snapshot", F.lit(1))
    return later.unionByName(earlier)


DEVICES_SQL = """
select distinct l_orderkey as host, l_linenumber as minor, 2 as snapshot from lineitem
union all
select distinct l_orderkey as host, l_linenumber as minor, 1 as snapshot
from lineitem where l_shipdate < cast('1997-01-01' as timestamp)
"""


def transfers(spark: SparkSession, sf: str) -> DataFrame:
    """A transfer summary line per document: its size in bytes and a time."""
    d = table(spark, sf, "documents")
    line = F.concat(F.octet_length("text").cast("string"), F.lit(" bytes copied, "),
                    (F.col("doc_id") % 50 + 1).cast("string"), F.lit(" s"))
    return d.select("doc_id", "source", line.alias("line"))


TRANSFERS_SQL = """
select doc_id, source,
       concat(cast(strlen(text) as varchar), ' bytes copied, ', cast(doc_id % 50 + 1 as varchar), ' s') as line
from documents
"""


def dd_log(spark: SparkSession, sf: str) -> DataFrame:
    """The copy report of each document as a block copy would print it:
    records in, records out (full + partial 512-byte records), bytes and
    seconds. Three lines per document, generated per row."""
    d = table(spark, sf, "documents")
    n = F.octet_length("text")
    records = F.concat(F.expr(f"octet_length(text) div {K.BLOCK_SIZE}").cast("string"), F.lit("+"),
                       F.when(n % K.BLOCK_SIZE > 0, F.lit("1")).otherwise(F.lit("0")))
    lines = F.array(F.concat(records, F.lit(" records in")),
                    F.concat(records, F.lit(" records out")),
                    F.concat(n.cast("string"), F.lit(" bytes copied, "),
                             (F.col("doc_id") % 50 + 1).cast("string"), F.lit(" s")))
    return d.where(F.col("text").isNotNull()).select("doc_id", "source", F.explode(lines).alias("line"))


DD_LOG_SQL = f"""
select doc_id, source, unnest([
         concat(cast(strlen(text) // {K.BLOCK_SIZE} as varchar), '+',
                case when strlen(text) % {K.BLOCK_SIZE} > 0 then '1' else '0' end, ' records in'),
         concat(cast(strlen(text) // {K.BLOCK_SIZE} as varchar), '+',
                case when strlen(text) % {K.BLOCK_SIZE} > 0 then '1' else '0' end, ' records out'),
         concat(cast(strlen(text) as varchar), ' bytes copied, ', cast(doc_id % 50 + 1 as varchar), ' s')
       ]) as line
from documents where text is not null
"""


def instance_states(spark: SparkSession, sf: str) -> DataFrame:
    """Events read as instance state reports: sign-up is a pending
    instance, an error a stopped one, a purchase a terminated one, anything
    else a running one."""
    e = table(spark, sf, "events")
    t = F.col("event_type")
    state = (F.when(t == "signup", F.lit("pending")).when(t == "error", F.lit("stopped"))
             .when(t == "purchase", F.lit(K.TERMINATED)).otherwise(F.lit("running")))
    return e.select("event_id", F.col("user_id").alias("instance"), "ts", state.alias("state"))


INSTANCE_STATES_SQL = """
select event_id, user_id as instance, ts,
       case event_type when 'signup' then 'pending' when 'error' then 'stopped'
                       when 'purchase' then 'terminated' else 'running' end as state
from events
"""

def state_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One line per event of a pretty-printed state report: most name a state,
    the others miss the quotes, the space or the word."""
    e = instance_states(spark, sf)
    k = F.col("event_id") % 8
    line = (F.when(k == 0, F.concat(F.lit('"Name":"'), F.col("state"), F.lit('"')))
            .when(k == 1, F.concat(F.lit('"Name": '), F.col("state")))
            .when(k == 2, F.concat(F.lit('"Code": "'), F.col("state"), F.lit('"')))
            .when(k == 3, F.concat(F.lit('  "Name": "'), F.col("state"), F.lit('", "Code": "80"')))
            .when(k == 4, F.lit('"Name": "two words"'))
            .otherwise(F.concat(F.lit('    "Name": "'), F.col("state"), F.lit('"'))))
    return e.select("event_id", line.alias("line"))


STATE_LINES_SQL = f"""
select event_id,
       case event_id % 8 when 0 then concat('"Name":"', state, '"') when 1 then concat('"Name": ', state)
            when 2 then concat('"Code": "', state, '"') when 3 then concat('  "Name": "', state, '", "Code": "80"')
            when 4 then '"Name": "two words"' else concat('    "Name": "', state, '"') end as line
from ({INSTANCE_STATES_SQL})
"""


def device_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The device listings as they come, rows repeated."""
    li = table(spark, sf, "lineitem")
    rows = li.select(F.col("l_orderkey").alias("host"), F.col("l_linenumber").alias("minor"), "l_shipdate")
    earlier = rows.where(F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    return rows.select("host", "minor", F.lit(2).alias("snapshot")).unionByName(
        earlier.select("host", "minor", F.lit(1).alias("snapshot")))


DEVICE_ROWS_SQL = """
select l_orderkey as host, l_linenumber as minor, 2 as snapshot from lineitem
union all
select l_orderkey as host, l_linenumber as minor, 1 as snapshot
from lineitem where l_shipdate < cast('1997-01-01' as timestamp)
"""

SQL = {
    "target_orders": TARGET_ORDERS_SQL,
    "listing": LISTING_SQL,
    "volumes": VOLUMES_SQL,
    "requests": REQUESTS_SQL,
    "sources": SOURCES_SQL,
    "workers": WORKERS_SQL,
    "steps": STEPS_SQL,
    "ledger": LEDGER_SQL,
    "devices": DEVICES_SQL,
    "transfers": TRANSFERS_SQL,
    "dd_log": DD_LOG_SQL,
    "instance_states": INSTANCE_STATES_SQL,
    "state_lines": STATE_LINES_SQL,
    "device_rows": DEVICE_ROWS_SQL,
}


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix an oracle query with the fixtures it reads, as CTEs."""
    if not names:
        return sql.strip()
    ctes = ",\n".join(f"{n} as ({SQL[n].strip()})" for n in names)
    return f"with {ctes}\n{sql.strip()}"
