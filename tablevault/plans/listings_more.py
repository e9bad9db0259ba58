"""Queries over records of several lines, dependencies, episodes and pattern tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablevault.functions import constants as K
from tablevault.operators.episodes import wait_episodes
from tablevault.operators.layers import cleanup_layers
from tablevault.operators.pattern_tables import match_lines_table, refs_missing_prefiltered
from tablevault.operators.records import OBJECT_END, explode_nested, extract_nested, json_objects, parse_device_tree, read_records
from tablevault.plans import fixtures as fx
from tablevault.plans.fixtures import with_fixtures
from tablevault.session import new_work_dir
from tablevault.sources.tables import table

# ---------------------------------------------------------------- O14: nested state in several lines


def state_objects(spark: SparkSession, sf: str) -> DataFrame:
    """One pretty-printed object for each instance report; every 13th is cut off after its
    code, every 17th has no state."""
    st = fx.instance_states(spark, sf)
    i = F.col("event_id").cast("string")
    state = F.concat(F.lit('  "State": {\n    "Code": '), (F.col("event_id") % 96).cast("string"), F.lit(',\n    "Name": "'),
                     F.col("state"), F.lit('"\n  },\n'))
    head = F.concat(F.lit('{\n  "InstanceId": "i-'), i, F.lit('",\n'))
    tags = F.concat(F.lit('  "Tags": [\n    {\n      "Key": "Name",\n      "Value": "{ box }\\n'), i,
                    F.lit('"\n    },\n    {\n      "Key": "Owner",\n      "Value": "'), F.col("instance").cast("string"),
                    F.lit('"\n    }\n  ]\n}'))
    cut = F.concat(head, F.lit('  "State": {\n    "Code": '), (F.col("event_id") % 96).cast("string"))
    whole = F.concat(head, F.when(F.col("event_id") % 17 == 0, F.lit("")).otherwise(state), tags)
    return st.select(F.when(F.col("event_id") % 13 == 0, cut).otherwise(whole).alias("value"))


def _objects(spark: SparkSession, sf: str, name: str) -> DataFrame:
    path = f"{new_work_dir(spark, name)}/reports"
    state_objects(spark, sf).write.text(path)
    return json_objects(read_records(spark, path, OBJECT_END))


def q_extract_nested_state(spark, sf):
    """State name and code of every report; broken reports keep their id, which is in their text."""
    found = extract_nested(_objects(spark, sf, "extract_nested_state"), {
        "state": ("$.State.Name", "string"), "code": ("$.State.Code", "int"), "_id": ("$.InstanceId", "string")}, keep=["text"])
    return found.select(F.regexp_extract("text", r'"InstanceId": "i-(\d+)"', 1).cast("long").alias("event_id"), "state", "code",
                        F.col("_id").isNull().alias("broken"))


def q_extract_nested_tags(spark, sf):
    """Every tag of every whole report."""
    objects = _objects(spark, sf, "extract_nested_tags").withColumn("id", F.try_variant_get("value", "$.InstanceId", "string"))
    tags = explode_nested(objects, "$.Tags", keep=["id"])
    return tags.select("id", "pos", F.try_variant_get("value", "$.Key", "string").alias("tag"),
                       F.try_variant_get("value", "$.Value", "string").alias("tag_value"))


# ---------------------------------------------------------------- O13, O20: device listings as printed

_CHILD, _GRANDCHILD = 2, 4  # devices with a number divisible by these have a child and a grandchild


def device_listings(spark: SparkSession, sf: str) -> DataFrame:
    """One ``lsblk`` listing per host: its devices, some with parts below them."""
    li = table(spark, sf, "lineitem")
    rows = li.groupBy(F.col("l_orderkey").alias("host"), F.col("l_linenumber").alias("m")).agg(
        F.min("l_quantity").cast("int").cast("string").alias("q"))

    def line(mark: str, name, major: str, size, mount):
        return F.concat(F.rpad(F.concat(F.lit(mark), name), 12, " "), F.rpad(F.concat(F.lit(f"{major}:"), F.col("m").cast("string")), 8, " "),
                        F.lit(" 0 "), F.lpad(size, 5, " "), F.lit("  0"), mount)

    name = F.concat(F.lit("xvda"), F.col("m").cast("string"))
    mount = F.when(F.col("m") == 1, F.lit(" /")).otherwise(F.lit(""))
    own = line("", name, "202", F.concat("q", F.lit("G")), mount)
    child = line("└─", F.concat(name, F.lit("p1")), "253", F.lit("512M"), F.concat(F.lit(" /mnt/p"), F.col("m").cast("string")))
    grand = line("  └─", F.concat(F.lit("vg"), F.col("m").cast("string")), "254", F.lit("9G"), F.lit(" [SWAP]"))
    lines = F.concat_ws("\n", own, F.when(F.col("m") % _CHILD == 0, child), F.when(F.col("m") % _GRANDCHILD == 0, grand))
    header = "NAME        MAJ:MIN RM  SIZE RO MOUNTPOINT"
    hosts = rows.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("m", lines.alias("l")))).alias("ls"))
    return hosts.select(F.concat(F.lit("host "), F.col("host").cast("string"), F.lit(f"\n$ lsblk\n{header}\n"),
                                 F.array_join(F.col("ls.l"), "\n"), F.lit("\n")).alias("value"))


def q_parse_device_tree(spark, sf):
    path = f"{new_work_dir(spark, 'parse_device_tree')}/listings"
    device_listings(spark, sf).write.text(path)
    records = read_records(spark, path, "\n\n").withColumn("host", F.regexp_extract("record", r"^host (\d+)", 1).cast("long"))
    return parse_device_tree(records, ["host"]).drop("line_no")


# ---------------------------------------------------------------- O25: dependencies

def cleanup_items(spark: SparkSession, sf: str) -> DataFrame:
    """What each run created, and an attachment for each run."""
    led = fx.ledger(spark, sf)
    return led.where("created_here").select("run_id", F.col("kind").alias("item")).unionByName(
        table(spark, sf, "orders").select(F.col("o_orderkey").alias("run_id"), F.lit("attachment").alias("item")))


_NEEDS = [("instance", "group"), ("instance", "key"), ("attachment", "instance"), ("attachment", "volume"), ("key", "key")]


def cleanup_needs(spark: SparkSession, sf: str) -> DataFrame:
    """Which item cannot outlive which; in every third run a key needs the group, and in every 97th the
    group needs the instance, a cycle."""
    runs = table(spark, sf, "orders").select(F.col("o_orderkey").alias("run_id"))
    pairs = F.array(*[F.struct(F.lit(a).alias("item"), F.lit(b).alias("needs")) for a, b in _NEEDS])
    more = F.filter(F.array(F.when(F.col("run_id") % 3 == 1, F.struct(F.lit("key").alias("item"), F.lit("group").alias("needs"))),
                            F.when(F.col("run_id") % 97 == 0, F.struct(F.lit("group").alias("item"), F.lit("instance").alias("needs")))),
                    lambda x: x.isNotNull())
    return runs.select("run_id", F.explode(F.concat(pairs, more)).alias("p")).select("run_id", "p.item", "p.needs")


def q_cleanup_layers(spark, sf):
    return cleanup_layers(cleanup_items(spark, sf), cleanup_needs(spark, sf), ["run_id"], "item")


# ---------------------------------------------------------------- O21, O11, O16

def q_wait_episodes(spark, sf):
    return wait_episodes(fx.instance_states(spark, sf), "instance", "ts", "state", K.TERMINATED, "event_id")


def line_patterns(spark: SparkSession, sf: str) -> DataFrame:
    """A literal for every third volume id, one for each zone and size, and some that no line holds."""
    c = table(spark, sf, "customer").where("c_custkey % 3 = 0").select(
        F.col("c_custkey").alias("pattern_id"), F.concat(F.lit("vol-"), (F.col("c_custkey") + 10000000).cast("string")).alias("literal"))
    n = F.col("n_nationkey")
    sizes = table(spark, sf, "nation").select(
        F.explode(F.array(F.struct((-1 - 2 * n).cast("long").alias("pattern_id"),
                                   F.concat(F.lit("a\tsize="), n.cast("string"), F.lit("\t")).alias("literal")),
                          F.struct((-2 - 2 * n).cast("long").alias("pattern_id"),
                                   F.concat(F.lit("z="), n.cast("string")).alias("literal")))).alias("p")).select("p.*")
    return c.unionByName(sizes)


def q_match_lines_table(spark, sf):
    return match_lines_table(fx.listing(spark, sf), ["c_custkey"], "line", line_patterns(spark, sf))


def q_refs_missing_prefiltered(spark, sf):
    req = fx.requests(spark, sf)
    return refs_missing_prefiltered(req, fx.volumes(spark, sf), "volume_id").select("request_id", "volume_id")


QUERIES = {
    "extract_nested_state": q_extract_nested_state,
    "extract_nested_tags": q_extract_nested_tags,
    "parse_device_tree": q_parse_device_tree,
    "cleanup_layers": q_cleanup_layers,
    "wait_episodes": q_wait_episodes,
    "match_lines_table": q_match_lines_table,
    "refs_missing_prefiltered": q_refs_missing_prefiltered,
}

_STEP = K.POLL_INTERVAL_S * 1_000_000
_needs_values = ", ".join(f"('{a}', '{b}')" for a, b in _NEEDS)

ORACLE_SQL = {
    "extract_nested_state": with_fixtures("""
        select event_id, case when event_id % 13 <> 0 and event_id % 17 <> 0 then state end as state,
               case when event_id % 13 <> 0 and event_id % 17 <> 0 then (event_id % 96)::int end as code,
               event_id % 13 = 0 as broken from instance_states""", "instance_states"),
    "extract_nested_tags": with_fixtures("""
        select concat('i-', event_id) as id, pos::int as pos, case pos when 0 then 'Name' else 'Owner' end as tag,
               case pos when 0 then concat('{ box }', chr(10), event_id) else instance::varchar end as tag_value
        from instance_states, (values (0), (1)) v(pos) where event_id % 13 <> 0""", "instance_states"),
    "parse_device_tree": f"""
        with d as (select l_orderkey as host, l_linenumber::int as m, min(l_quantity)::int as q from lineitem group by 1, 2)
        select host, concat('xvda', m) as name, 202::int as major, m as minor, concat(q, 'G') as size,
               case when m = 1 then '/' end as mountpoint, null as parent from d
        union all
        select host, concat('xvda', m, 'p1'), 253, m, '512M', concat('/mnt/p', m), concat('xvda', m) from d where m % {_CHILD} = 0
        union all
        select host, concat('vg', m), 254, m, '9G', '[SWAP]', concat('xvda', m, 'p1') from d where m % {_GRANDCHILD} = 0""",
    "cleanup_layers": with_fixtures(f"""
        , n as (select run_id, kind as item from ledger where created_here
                union select o_orderkey, 'attachment' from orders),
        p as (select o_orderkey as run_id, above, below from orders, (values {_needs_values}) v(above, below) where above <> below
              union select o_orderkey, 'key', 'group' from orders where o_orderkey % 3 = 1
              union select o_orderkey, 'group', 'instance' from orders where o_orderkey % 97 = 0),
        e as (select p.* from p join n a on a.run_id = p.run_id and a.item = above join n b on b.run_id = p.run_id and b.item = below),
        r as (select run_id, item, 0 as d from n
              union select e.run_id, below, d + 1 from r join e on e.run_id = r.run_id and e.above = r.item where d < 12)
        select run_id, item, case when max(d) < 12 then max(d) end::int as layer, max(d) >= 12 as cyclic from r group by run_id, item""",
                                    "ledger").replace("with ", "with recursive ", 1).replace(")\n, n as", "), n as", 1),
    "wait_episodes": with_fixtures(f"""
        , a as (select *, state = '{K.TERMINATED}' as there, lag(state = '{K.TERMINATED}') over (partition by instance order by ts, event_id) as prior
                from instance_states),
        b as (select *, sum((prior is null or (prior and not there))::int) over (partition by instance order by ts, event_id) as episode from a),
        g as (select instance, episode::bigint as episode, min(ts) as started, min(ts) filter (where there) as reached_at, count(*) as reports
              from b group by 1, 2),
        u as (select *, epoch_us(reached_at) - epoch_us(started) as us from g),
        q as (select *, case when us is null then null when us <= 0 then 0 else (us + {_STEP} - 1) // {_STEP} + 1 end as polls from u)
        select instance, episode, started, reached_at, reports, us / 1000000.0::double as wait_s, polls::bigint as polls,
               (polls * {K.POLL_INTERVAL_S})::bigint as slept_s, ((polls + 1) * {K.POLL_INTERVAL_S})::bigint as reported_s,
               reached_at is not null as reached from q""", "instance_states").replace(")\n, a as", "), a as", 1),
    "match_lines_table": with_fixtures("""
        select l.c_custkey, pattern_id from listing l join (
          select c_custkey as pattern_id, concat('vol-', 10000000 + c_custkey) as literal from customer where c_custkey % 3 = 0
          union all select -1 - 2 * n_nationkey, concat('a', chr(9), 'size=', n_nationkey, chr(9)) from nation
          union all select -2 - 2 * n_nationkey, concat('z=', n_nationkey) from nation) p on contains(line, literal)""", "listing"),
    "refs_missing_prefiltered": with_fixtures("""
        select request_id, volume_id from requests r
        where not exists (select 1 from volumes v where v.volume_id = r.volume_id)""", "requests", "volumes"),
}
