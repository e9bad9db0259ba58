from pyspark.sql import functions as F

from tablevault import operators as op


def test_volume_gib_matches_shell_arithmetic(spark):
    # kib -> gib as computed by hand from the shell steps (*2, /1024, /1024, +2)
    sizes = [(0, 2), (524287, 2), (524288, 3), (1048576, 4)]
    df = spark.createDataFrame(sizes, "kib long, gib long")
    got = df.select("kib", op.volume_gib("kib").alias("got"), "gib").collect()
    for r in got:
        assert r["got"] == r["gib"]
    for kib, _ in sizes:
        assert ((kib * 2) // 1024) // 1024 + 2 == (kib * 2) // 1048576 + 2


def test_plan_size_groups_and_rounds_up(spark):
    df = spark.createDataFrame([("a", "x" * 1025), ("a", "é"), ("b", None)], "g string, t string")
    got = {r["g"]: r for r in op.plan_size(df, ["g"], ["t"]).collect()}
    assert got["a"]["bytes"] == 1025 + 2 and got["a"]["kib"] == 2 and got["a"]["gib"] == 2
    assert got["b"]["bytes"] == 0 and got["b"]["kib"] == 0 and got["b"]["gib"] == 2


def test_block_counts_reproduce_the_dd_log(spark):
    # 2986034+1 records of 512 bytes for 1528849884 bytes
    df = spark.createDataFrame([(1528849884,), (0,), (512,), (513,)], "n long")
    rows = df.select("n", *op.block_counts("n")).collect()
    by_n = {r["n"]: r for r in rows}
    assert (by_n[1528849884]["full_blocks"], by_n[1528849884]["partial_blocks"]) == (2986034, 1)
    assert by_n[1528849884]["padded_bytes"] == 2986035 * 512
    assert (by_n[0]["full_blocks"], by_n[0]["partial_blocks"], by_n[0]["padded_bytes"]) == (0, 0, 0)
    assert (by_n[512]["full_blocks"], by_n[512]["partial_blocks"]) == (1, 0)
    assert (by_n[513]["full_blocks"], by_n[513]["partial_blocks"], by_n[513]["padded_bytes"]) == (1, 1, 1024)


def test_block_layout_counts_bytes_not_characters(spark):
    df = spark.createDataFrame([(1, "é" * 300), (2, ""), (3, None)], "id int, t string")
    got = {r["id"]: r for r in op.block_layout(df, ["id"], "t").collect()}
    assert got[1]["bytes"] == 600 and got[1]["full_blocks"] == 1 and got[1]["partial_blocks"] == 1
    assert got[2]["bytes"] == 0 and got[2]["padded_bytes"] == 0
    assert got[3]["bytes"] == 0


def test_block_split_round_trip_and_padding(spark):
    texts = [(1, "héllo wörld " * 100), (2, "x" * 512), (3, ""), (4, None), (5, "y")]
    df = spark.createDataFrame(texts, "id int, t string")
    blocks = op.block_split(df, ["id"], "t", size=64).collect()
    by_id = {}
    for r in blocks:
        by_id.setdefault(r["id"], []).append((r["block_no"], bytes(r["block"])))
    assert 3 not in by_id and 4 not in by_id
    for i, t in texts:
        if not t:
            continue
        parts = sorted(by_id[i])
        assert [p[0] for p in parts] == list(range(len(parts)))
        assert all(len(b) == 64 for _, b in parts)
        raw = t.encode("utf-8")
        joined = b"".join(b for _, b in parts)
        assert joined[:len(raw)] == raw and set(joined[len(raw):]) <= {0}
        assert len(parts) == -(-len(raw) // 64)
    layout = {r["id"]: r for r in op.block_layout(df, ["id"], "t", size=64).collect()}
    for i, parts in by_id.items():
        assert len(parts) == layout[i]["full_blocks"] + layout[i]["partial_blocks"]


def test_transfer_log_parsing_and_rate(spark):
    log = [("r1", "2986034+1 records in"), ("r1", "2986034+1 records out"),
           ("r1", "1528849884 bytes (1.5 GB) copied, 460.558 s, 3.3 MB/s")]
    df = spark.createDataFrame(log, "run string, line string")
    rec = op.parse_records(df).where(F.col("direction").isNotNull()).collect()
    assert {(r["full_records"], r["partial_records"], r["direction"]) for r in rec} == {
        (2986034, 1, "in"), (2986034, 1, "out")}
    (r,) = op.transfer_rate(df, ["run"]).collect()
    assert r["bytes"] == 1528849884 and abs(r["seconds"] - 460.558) < 1e-9
    assert round(r["mb_per_s"], 1) == 3.3


def test_transfer_rate_is_total_over_total_and_null_on_zero_time(spark):
    df = spark.createDataFrame([("a", "1000000 bytes copied, 1 s"), ("a", "3000000 bytes copied, 3 s"),
                                ("b", "5 bytes copied, 0 s"), ("c", "garbage")], "g string, line string")
    got = {r["g"]: r for r in op.transfer_rate(df, ["g"]).collect()}
    assert got["a"]["mb_per_s"] == 1.0
    assert got["b"]["mb_per_s"] is None
    assert "c" not in got


def test_plan_size_files_takes_the_root_literally(spark):
    from tablevault import operators as op

    for root in ("/data/x+y(1)", "file:/data/x+y(1)", "file:///data/x+y(1)/"):
        files = spark.createDataFrame([("file:/data/x+y(1)/a/f1", 10), ("file:///data/x+y(1)/a/b/f2", 5),
                                       ("/data/x+y(1)/f3", 7), ("file:/data/xxy1/f4", 1)], "path string, length long")
        got = {r["folder"]: r["bytes"] for r in op.plan_size_files(files.where("length > 1"), root).collect()}
        assert got == {"a": 15, ".": 7}
