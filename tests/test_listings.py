from tablevault import operators as op
from tablevault.functions import constants as K


def test_zone_pattern_is_greedy_and_over_captures(spark):
    lines = ["us-east-1a", "eu-central-1a", "ap-southeast-1a", "sa-east-1a", '"eu-west-1a",']
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "id int, line string")
    got = {r["id"]: r["token"] for r in op.extract_tokens(df, ["id"], "line", K.ZONE_PATTERN).collect()}
    assert got == {0: "us-east-1a", 1: "eu-central-1a", 2: "ap-southeast-1a", 3: "sa-east-1a",
                   4: 'eu-west-1a",'}


def test_instance_and_volume_ids_cut_to_eight(spark):
    df = spark.createDataFrame([(1, 'x "i-1234567890" vol-abcdefghij i-00000001'),
                                (2, "i-12345678 at line start")], "id int, line string")
    inst = op.extract_tokens(df, ["id"], "line", K.INSTANCE_ID_PATTERN, K.INSTANCE_ID_GROUP).collect()
    assert {(r["id"], r["pos"], r["token"]) for r in inst} == {(1, 0, "i-12345678"), (1, 1, "i-00000001")}
    vol = op.extract_tokens(df, ["id"], "line", K.VOLUME_ID_PATTERN).collect()
    assert [r["token"] for r in vol] == ["vol-abcdefgh"]


def test_match_lines_is_and_of_unanchored_patterns(spark):
    df = spark.createDataFrame([("kernel: xvdf 3156 attached",), ("xvdf 1",), ("3156 only",)], "line string")
    got = [r["line"] for r in op.match_lines(df, "line", ["xvdf", "3156"]).collect()]
    assert got == ["kernel: xvdf 3156 attached"]


def test_pick_fields_cut_rules(spark):
    inst = "\t".join(f"f{i}" for i in range(1, 16)) + "\t54.1.2.3\tmore"
    rows = [(1, "vol-12345678\tus-east-1b\tin-use"), (2, "no tabs here"), (3, inst), (4, "a\tb")]
    df = spark.createDataFrame(rows, "id int, line string")
    got = {r["id"]: r for r in op.pick_fields(
        df, "line", "\t", fields={"zone": 2, "ip": 16}, chars={"c": (29, 32)}, keep=["id"]).collect()}
    assert got[1]["zone"] == "us-east-1b"
    assert got[2]["zone"] == "no tabs here" and got[2]["ip"] == "no tabs here"
    assert got[3]["ip"] == "54.1.2.3"
    assert got[4]["ip"] == ""
    assert got[1]["c"] == rows[0][1][28:32] == "se" and got[3]["c"] == inst[28:32]
    assert got[4]["c"] == ""
    words = op.pick_fields(spark.createDataFrame([("/dev/xvdf: data",)], "line string"), "line", " ",
                           fields={"second": 2}).collect()
    assert words[0]["second"] == "data"


def test_extract_named_value_matches_only_the_exact_form(spark):
    lines = ['            "Name": "terminated"', '"GroupName": "x"', '"Name":"x"', '"Name": "two words"']
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "id int, line string")
    got = [(r["id"], r["value"]) for r in op.extract_named_value(df, ["id"], "line", "Name").collect()]
    assert got == [(0, "terminated")]
    nums = spark.createDataFrame([(1, '{"k": 69}'), (2, '{"k":1}')], "id int, p string")
    got = [(r["id"], r["value"]) for r in op.extract_named_value(nums, ["id"], "p", "k", quoted=False).collect()]
    assert got == [(1, "69")]


def test_lookup_field_gives_every_match(spark):
    req = spark.createDataFrame([(1, "vol-a"), (2, "vol-b"), (3, None)], "rid int, volume_id string")
    lst = spark.createDataFrame([("vol-a", "z1"), ("vol-a", "z2"), ("vol-c", "z3")],
                                "volume_id string, zone string")
    got = sorted((r["rid"], r["zone"]) for r in op.lookup_field(req, lst, "volume_id", ["zone"]).collect())
    assert got == [(1, "z1"), (1, "z2")]


def test_first_pattern_respects_list_order(spark):
    df = spark.createDataFrame([(1, "xvdf nvme0n1"), (2, "sdb"), (3, "none")], "id int, line string")
    pats = [("xen", r"xvd[a-z]", 0), ("nvme", r"nvme\d+n\d+", 0), ("scsi", r"sd[a-z]", 0)]
    got = {r["id"]: (r["pattern"], r["value"]) for r in op.first_pattern(df, "line", pats, keep=["id"]).collect()}
    assert got == {1: ("xen", "xvdf"), 2: ("scsi", "sdb"), 3: (None, None)}


def test_null_lines_stay_null(spark):
    df = spark.createDataFrame([(1, None)], "id int, line string")
    (r,) = op.pick_fields(df, "line", "\t", fields={"f": 2}, chars={"c": (1, 3)}, keep=["id"]).collect()
    assert r["f"] is None and r["c"] is None
    assert op.extract_tokens(df, ["id"], "line", K.VOLUME_ID_PATTERN).count() == 0
    assert op.match_lines(df, "line", ["x"]).count() == 0
