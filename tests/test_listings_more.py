"""Records of several lines, dependency layers, episodes, pattern tables and inventory filters."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tablevault.operators import refs_missing
from tablevault.operators.episodes import wait_episodes
from tablevault.operators.layers import cleanup_layers
from tablevault.operators.pattern_tables import (
    filter_error,
    inventory_filter,
    match_lines_table,
    maybe_present,
    merge_filters,
    refs_missing_prefiltered,
)
from tablevault.operators.records import OBJECT_END, explode_nested, extract_nested, json_objects, parse_device_tree, read_records
from tablevault.sources import fs


def _rows(df, *cols):
    return sorted(map(tuple, (df.select(*cols) if cols else df).collect()), key=str)


def _text(spark, path, *files):
    for k, f in enumerate(files):
        fs.write_text(spark, f"{path}/{k}.txt", f)


# ------------------------------------------------------------------ O14

WHOLE = '{{\n  "Id": "{i}",\n  "State": {{\n    "Name": "run\\n}}ning {i}"\n  }},\n  "Tags": [ {{"Key": "a"}}, {{"Key": "b"}} ]\n}}'


def test_objects_over_lines_and_broken_ones(spark, workdir):
    broken = '{\n  "Id": "cut",\n  "State": {'
    files = ["\n".join([WHOLE.format(i=1), broken, WHOLE.format(i=2)]) + "\n", WHOLE.format(i=3), "\n\n", broken + "\n", "no object\n",
             "junk before\n" + WHOLE.format(i=4) + "\n" + '{\n  "Id": 5,\n  "State": "flat"\n}\n']
    _text(spark, f"{workdir}/in", *files)
    objects = json_objects(read_records(spark, f"{workdir}/in", OBJECT_END))
    found = extract_nested(objects, {"id": ("$.Id", "string"), "state": ("$.State.Name", "string")}, keep=["text"])
    assert _rows(found, "id", "state") == sorted(
        [(str(i), f"run\n}}ning {i}") for i in (1, 2, 3, 4)] + [("5", None), (None, None), (None, None)], key=str)
    assert found.where("id is null and text like '%cut%'").count() == 2
    tags = explode_nested(objects, "$.Tags", keep=["file"]).select("pos", F.try_variant_get("value", "$.Key", "string"))
    assert _rows(tags) == sorted([(0, "a"), (1, "b")] * 4, key=str)


def test_objects_are_whole_whatever_the_splits(spark, workdir):
    _text(spark, f"{workdir}/in", "".join(WHOLE.format(i=i) + "\n" for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.openCostInBytes", "5000")
    try:
        records = read_records(spark, f"{workdir}/in", OBJECT_END)
        assert records.rdd.getNumPartitions() > 20
        ids = extract_nested(json_objects(records), {"id": ("$.Id", "int")})
        assert sorted(r["id"] for r in ids.collect()) == list(range(3000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


# ------------------------------------------------------------------ O13, O20

TREE = """host 7
$ lsblk
NAME          MAJ:MIN RM   SIZE RO MOUNTPOINT
xvda          202:0    0     8G  0
├─xvda1       202:1    0     1G  0 /boot
└─xvda2       202:2    0     7G  0
  ├─vg-root   253:0    0     6G  0 /
  │ └─crypt   254:0    1   5.5G  0 /secret
  └─vg-swap   253:1    0     1G  1 [SWAP]
sr0            11:0    1  1024M  0
xvdb          202:16   0   100G  0 /data"""


def test_device_tree_as_printed(spark, workdir):
    flat = "host 8\nNAME  MAJ:MIN RM SIZE RO MOUNTPOINT\nxvda1 202:1    0   8G  0 /\nxvda2 202:2    0   1G  0 \nxvda3 202:3    0   1G  0"
    _text(spark, f"{workdir}/in", TREE + "\n\n" + flat + "\n", "host 9\n\nno header here\n")
    records = read_records(spark, f"{workdir}/in", "\n\n").withColumn("host", F.regexp_extract("record", r"host (\d+)", 1))
    got = parse_device_tree(records, ["host"])
    assert [tuple(r)[2:] for r in got.where("host = 7").orderBy("line_no").collect()] == [
        ("xvda", 202, 0, "8G", None, None), ("xvda1", 202, 1, "1G", "/boot", "xvda"), ("xvda2", 202, 2, "7G", None, "xvda"),
        ("vg-root", 253, 0, "6G", "/", "xvda2"), ("crypt", 254, 0, "5.5G", "/secret", "vg-root"),
        ("vg-swap", 253, 1, "1G", "[SWAP]", "xvda2"), ("sr0", 11, 0, "1024M", None, None), ("xvdb", 202, 16, "100G", "/data", None)]
    assert _rows(got.where("host = 8"), "name", "major", "minor", "size", "mountpoint", "parent") == [
        ("xvda1", 202, 1, "8G", "/", None), ("xvda2", 202, 2, "1G", None, None), ("xvda3", 202, 3, "1G", None, None)]
    assert got.where("host = 9").isEmpty()


# ------------------------------------------------------------------ O25

def _layers(items, needs):
    left, layer, out = set(items), 0, {}
    edges = {(r, a, b) for r, a, b in needs if a != b and None not in (a, b) and (r, a) in left and (r, b) in left}
    while True:
        free = {(r, i) for r, i in left if i is not None and not any((r, a) in left and b == i for q, a, b in edges if q == r)}
        if not free:
            return out | {x: None for x in left}
        out |= {x: layer for x in free}
        left -= free
        layer += 1


def test_layers_equal_peeling_by_hand(spark):
    rng = random.Random(5)
    items = [(r, f"i{k}") for r in range(12) for k in range(rng.randint(1, 9))]
    needs = [(r, f"i{rng.randint(0, 8)}", f"i{rng.randint(0, 9)}") for r in range(12) for _ in range(rng.randint(0, 9))]
    needs += [(1, None, "i0"), (1, "i0", None)] + needs[:5]
    got = cleanup_layers(spark.createDataFrame(items + items[:3], "run long, item string"),
                         spark.createDataFrame(needs, "run long, item string, needs string"), ["run"], "item")
    want = _layers(items, needs)
    assert None in want.values() and max(v for v in want.values() if v is not None) >= 2
    assert _rows(got) == sorted([(r, i, n, n is None) for (r, i), n in want.items()], key=str)


def test_layers_of_a_long_chain_and_of_nothing(spark):
    n = 17
    items = spark.createDataFrame([(1, str(k)) for k in range(n)], "run long, item string").repartition(4)
    needs = spark.createDataFrame([(1, str(k), str(k + 1)) for k in range(n - 1)], "run long, item string, needs string")
    got = cleanup_layers(items, needs, ["run"], "item")
    assert _rows(got) == sorted([(1, str(k), k, False) for k in range(n)], key=str)
    assert cleanup_layers(items.limit(0), needs, ["run"], "item").isEmpty()
    circle = needs.unionByName(spark.createDataFrame([(1, str(n - 1), "0")], needs.schema))
    assert _rows(cleanup_layers(items, circle, ["run"], "item")) == sorted([(1, str(k), None, True) for k in range(n)], key=str)


# ------------------------------------------------------------------ O21

def _episodes(events, target):
    out, prior = [], None
    for ts, _, state in sorted(events):
        there = state == target
        if prior is None or (prior and not there):
            out.append([ts, None, 0])
        out[-1][2] += 1
        if there and out[-1][1] is None:
            out[-1][1] = ts
        prior = there
    return out


@pytest.mark.parametrize("slice_s", [7, 60, 10**6])
def test_episodes_are_carried_over_slices(spark, slice_s):
    rng = random.Random(9)
    base = dt.datetime(2024, 1, 1)
    rows = [(k, base + dt.timedelta(seconds=rng.randint(0, 300) - 100), n, rng.choice(["t", "a", "b", None]))
            for k in range(6) for n in range(10 ** (k % 3))]
    rows += [(None, base, 1, "t"), (3, None, -1, "t")]
    ev = spark.createDataFrame(rows, "k long, ts timestamp_ntz, n long, state string").repartition(5)
    got = wait_episodes(ev, "k", "ts", "state", "t", "n", slice_s=slice_s)
    want = [(k, i + 1, *e) for k in range(6)
            for i, e in enumerate(_episodes([r[1:] for r in rows if r[0] == k and r[1]], "t"))]
    assert _rows(got, "k", "episode", "started", "reached_at", "reports") == sorted(want, key=str)
    assert got.where("reached <> (reached_at is not null) or polls <> case when wait_s <= 0 then 0 else ceil(wait_s / 10) + 1 end").isEmpty()


# ------------------------------------------------------------------ O11

def test_pattern_table_equals_contains(spark):
    rng = random.Random(2)
    lines = ["".join(rng.choice("ab é😀\t") for _ in range(rng.randint(0, 30))) for _ in range(300)] + [None, "", "x" * 5000]
    literals = ["".join(rng.choice("ab é😀\t") for _ in range(rng.randint(1, 11))) for _ in range(200)] + ["", "zz", None, "x" * 4000, "ab", "ab"]
    got = match_lines_table(spark.createDataFrame(list(enumerate(lines)), "id long, line string").repartition(3), ["id"], "line",
                            spark.createDataFrame(list(enumerate(literals)), "pattern_id long, literal string"))
    want = [(i, p) for i, line in enumerate(lines) for p, lit in enumerate(literals) if line is not None and lit is not None and lit in line]
    assert _rows(got) == sorted(want, key=str) and len(want) > 300


def test_thousands_of_patterns_need_no_cross_join(spark):
    lines = spark.range(2000).selectExpr("id", "concat('vol-', id * 7, '\t', 'z', id % 5) as line")
    patterns = spark.range(5000).selectExpr("id as pattern_id", "concat('vol-', id, '\t') as literal")
    got = match_lines_table(lines, ["id"], "line", patterns)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert got.count() == len([i for i in range(2000) if i * 7 < 5000])


# ------------------------------------------------------------------ O16

def test_prefiltered_missing_references_equal_the_plain_join(spark):
    req = spark.createDataFrame([(i, f"v{i % 700}" if i % 9 else ("" if i % 2 else None)) for i in range(3000)], "r long, v string")
    ref = spark.createDataFrame([(f"v{i}",) for i in range(0, 700, 3)] * 3 + [("",), (None,)], "v string")
    want = _rows(refs_missing(req, ref, "v"))
    assert _rows(refs_missing_prefiltered(req, ref, "v")) == want
    assert _rows(refs_missing_prefiltered(req, ref, "v", bits=1 << 16)) == want
    assert _rows(refs_missing_prefiltered(req, ref, "v", bits=64)) == want  # a filter that lets nearly all through


def test_filter_never_misses_merges_and_errs_as_stated(spark):
    bits = 1 << 16
    inside = spark.range(8000).selectExpr("cast(id as string) as v")
    outside = spark.range(10_000, 60_000).selectExpr("cast(id as string) as v")
    sketch = inventory_filter(inside, "v", bits)
    assert maybe_present(inside, "v", sketch, "maybe", bits).where("not maybe").isEmpty()
    rate = maybe_present(outside, "v", sketch, "maybe", bits).where("maybe").count() / 50_000
    assert abs(rate - filter_error(8000, bits)) < 0.005
    parts = [inventory_filter(inside.where(f"v % 3 = {k}"), "v", bits) for k in range(3)]
    assert _rows(merge_filters(parts)) == _rows(sketch)


def test_few_rows_are_shuffled_behind_the_filter(spark):
    req = spark.range(20_000).selectExpr("id as r", "concat('v', id) as v")
    ref = spark.range(100).selectExpr("concat('v', id * 10) as v")
    sketch = inventory_filter(ref, "v")
    open_ = maybe_present(req, "v", sketch, "maybe").where("maybe")
    assert 100 <= open_.count() <= 110  # of 20,000 rows that the plain join would shuffle
    assert refs_missing_prefiltered(req, ref, "v").count() == 19_900
