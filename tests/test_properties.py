"""Property tests: operators against small Python models of the shell behaviour.

Each example batches many cases into one DataFrame so that a Spark job
checks all of them at once.
"""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablevault import operators as op

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


def cut_model(line: str, delim: str, n: int) -> str:
    """POSIX ``cut -d DELIM -f N`` on one line."""
    if delim not in line:
        return line
    parts = line.split(delim)
    return parts[n - 1] if n <= len(parts) else ""


@SETTINGS
@given(lines=st.lists(st.text(alphabet="ab\t x", max_size=12), min_size=1, max_size=40),
       n=st.integers(min_value=1, max_value=5))
def test_pick_fields_is_cut(spark, lines, n):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "id int, line string")
    got = {r["id"]: r["f"] for r in op.pick_fields(df, "line", "\t", fields={"f": n}, keep=["id"]).collect()}
    assert got == {i: cut_model(s, "\t", n) for i, s in enumerate(lines)}


@SETTINGS
@given(texts=st.lists(st.text(max_size=300), min_size=1, max_size=15),
       size=st.integers(min_value=1, max_value=64))
def test_block_split_round_trips(spark, texts, size):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "id int, t string")
    blocks = {}
    for r in op.block_split(df, ["id"], "t", size=size).collect():
        blocks.setdefault(r["id"], []).append((r["block_no"], bytes(r["block"])))
    for i, s in enumerate(texts):
        raw = s.encode("utf-8")
        got = sorted(blocks.get(i, []))
        assert len(got) == -(-len(raw) // size)
        joined = b"".join(b for _, b in got)
        assert joined[:len(raw)] == raw and set(joined[len(raw):]) <= {0}
        assert all(len(b) == size for _, b in got)


def poll_model(t_us: int, poll_s: int = 10):
    """Run the shell's wait loop: one check, then check / sleep / count."""
    if t_us <= 0:
        return 0
    turns, now_us = 0, 0
    while True:
        seen = now_us >= t_us      # check at the top of the loop body
        now_us += poll_s * 1_000_000  # sleep
        turns += 1
        if seen:
            return turns


@SETTINGS
@given(waits=st.lists(st.integers(min_value=-5_000_000, max_value=200_000_000), min_size=1, max_size=30))
def test_wait_profile_matches_the_poll_loop(spark, waits):
    base = dt.datetime(2024, 1, 1, 12)
    rows = []
    for i, w in enumerate(waits):
        start = base - dt.timedelta(microseconds=min(w, 0))
        rows.append((i, start, "running"))
        rows.append((i, start + dt.timedelta(microseconds=max(w, 0)), "terminated"))
    df = spark.createDataFrame(rows, "k int, ts timestamp_ntz, state string")
    got = {r["k"]: (r["polls"], r["slept_s"], r["reported_s"])
           for r in op.wait_profile(df, "k", "ts", "state", "terminated").collect()}
    for i, w in enumerate(waits):
        p = poll_model(max(w, 0))
        assert got[i] == (p, 10 * p, 10 * (p + 1))


keyed_rows = st.dictionaries(st.integers(min_value=0, max_value=30),
                             st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.text(max_size=4)),
                             max_size=25)


@SETTINGS
@given(src=keyed_rows, tgt=keyed_rows)
def test_sync_diff_and_apply_follow_the_model(spark, src, tgt):
    schema = "k long, sig int, payload string"
    s = spark.createDataFrame([(k, a, b) for k, (a, b) in src.items()], schema)
    t = spark.createDataFrame([(k, a, b) for k, (a, b) in tgt.items()], schema)
    got = {r["k"]: r["cls"] for r in op.sync_diff(s, t, ["k"], ["sig"]).collect()}
    want = {}
    for k in set(src) | set(tgt):
        if k not in tgt:
            want[k] = "new"
        elif k not in src:
            want[k] = "target_only"
        else:
            want[k] = "unchanged" if src[k][0] == tgt[k][0] else "changed"
    assert got == want
    applied = {r["k"]: (r["sig"], r["payload"]) for r in op.sync_apply(s, t, ["k"]).collect()}
    assert applied == {**tgt, **src}


METHODS = st.sampled_from([None, "", "dd", "rsync", "tar"])
VOLUMES = st.sampled_from([None, "", "vol-1", "vol-2", "vol-3", "vol-9"])
SOURCES = st.sampled_from([None, 10, 11, 99])
INVENTORY = {"vol-1": "data", "vol-2": "ext4", "vol-3": "xfs"}


def verdict_model(method, volume, source):
    m = method or "dd"
    if m not in ("dd", "rsync"):
        return m, "bad_method"
    if volume == "":
        return m, "volume_blank"
    if volume is not None and volume not in INVENTORY:
        return m, "volume_unknown"
    if source is None:
        return m, "source_missing"
    if source not in (10, 11):
        return m, "source_unknown"
    return m, "ok"


def prepare_model(volume):
    if not volume:
        return "create"
    fs = INVENTORY.get(volume)
    if fs is None:
        return "reject"
    return {"data": "format_mount", "ext4": "mount"}.get(fs, "rollback")


@SETTINGS
@given(reqs=st.lists(st.tuples(METHODS, VOLUMES, SOURCES), min_size=1, max_size=40))
def test_request_rules_follow_the_model(spark, reqs):
    rows = [(i, m, v, s) for i, (m, v, s) in enumerate(reqs)]
    req = spark.createDataFrame(rows, "request_id int, method string, volume_id string, source_id long")
    vol = spark.createDataFrame([(k, "z", f) for k, f in INVENTORY.items()], "volume_id string, zone string, fs string")
    src = spark.createDataFrame([(10,), (11,)], "source_id long")
    got = {r["request_id"]: (r["method"], r["verdict"]) for r in op.validate_requests(req, vol, src).collect()}
    assert got == {i: verdict_model(m, v, s) for i, m, v, s in rows}
    acts = {r["request_id"]: r["action"] for r in op.route_prepare(req, vol).collect()}
    assert acts == {i: prepare_model(v) for i, _, v, _ in rows}


@SETTINGS
@given(lines=st.lists(st.text(alphabet='ab"=h x', max_size=30), min_size=1, max_size=30))
def test_extract_tokens_finds_every_match_left_to_right(spark, lines):
    import re

    pattern = r'h="([^"]*)"'
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "id int, line string")
    got = sorted((r["id"], r["pos"], r["token"]) for r in op.extract_tokens(df, ["id"], "line", pattern, 1).collect())
    want = sorted((i, p, m.group(1)) for i, s in enumerate(lines)
                  for p, m in enumerate(re.finditer(pattern, s)))
    assert got == want


@SETTINGS
@given(texts=st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.one_of(st.none(), st.text(max_size=2000))),
                      min_size=1, max_size=30))
def test_sizes_and_blocks_follow_the_byte_model(spark, texts):
    df = spark.createDataFrame([(i, g, t) for i, (g, t) in enumerate(texts)], "id int, g string, t string")
    sizes = {r["g"]: (r["bytes"], r["kib"], r["gib"]) for r in op.plan_size(df, ["g"], ["t"]).collect()}
    want = {}
    for g, t in texts:
        want[g] = want.get(g, 0) + (len(t.encode("utf-8")) if t is not None else 0)
    assert sizes == {g: (b, -(-b // 1024), (-(-b // 1024) * 2) // 1048576 + 2) for g, b in want.items()}
    layout = {r["id"]: (r["full_blocks"], r["partial_blocks"], r["padded_bytes"])
              for r in op.block_layout(df, ["id"], "t").collect()}
    for i, (_, t) in enumerate(texts):
        n = len(t.encode("utf-8")) if t is not None else 0
        full, part = n // 512, 1 if n % 512 else 0
        assert layout[i] == (full, part, (full + part) * 512)


@SETTINGS
@given(reqs=st.lists(st.tuples(METHODS, VOLUMES), min_size=1, max_size=40))
def test_route_plan_follows_the_rule_table(spark, reqs):
    df = spark.createDataFrame([(i, m, v) for i, (m, v) in enumerate(reqs)], "id int, method string, volume_id string")
    got = {r["id"]: r["plan"] for r in op.route_plan(df).collect()}
    table = {("dd", True): "a", ("dd", False): "b", ("rsync", True): "c", ("rsync", False): "d"}
    assert got == {i: table.get((m or "dd", bool(v))) for i, (m, v) in enumerate(reqs)}


ROWS = st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.sampled_from(["x", "y"])))


@SETTINGS
@given(after=st.lists(ROWS, max_size=30), before=st.lists(ROWS, max_size=30))
def test_new_entries_is_set_difference_with_nulls_equal(spark, after, before):
    schema = "a int, b string"
    got = {tuple(r) for r in op.new_entries(spark.createDataFrame(after, schema),
                                            spark.createDataFrame(before, schema)).collect()}
    rows = op.new_entries(spark.createDataFrame(after, schema), spark.createDataFrame(before, schema)).count()
    assert got == set(after) - set(before) and rows == len(got)


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50), st.text(alphabet="abc", max_size=3)),
                     min_size=1, max_size=40))
def test_latest_entry_is_the_max_row_per_group(spark, rows):
    df = spark.createDataFrame(rows, "g int, n int, v string")
    got = {r["g"]: (r["n"], r["v"]) for r in op.latest_entry(df, ["g"], ["n"]).collect()}
    want = {}
    for g, n, v in rows:
        want[g] = max(want.get(g, (n, v)), (n, v))
    assert got == want


@SETTINGS
@given(steps=st.lists(st.tuples(st.integers(0, 5), st.integers(1, 6), st.integers(0, 2)), min_size=1, max_size=40))
def test_run_outcome_follows_the_model(spark, steps):
    df = spark.createDataFrame(steps, "run_id long, step_no int, rc int")
    got = {r["run_id"]: (r["exit_code"], r["failed_step"], r["steps"]) for r in op.run_outcome(df).collect()}
    want = {}
    for run in {s[0] for s in steps}:
        mine = [s for s in steps if s[0] == run]
        failed = [s[1] for s in mine if s[2] != 0]
        want[run] = (1 if failed else 0, min(failed) if failed else None, len(mine))
    assert got == want


KINDS = ["instance", "group", "key", "volume"]


@SETTINGS
@given(ledger=st.lists(st.tuples(st.integers(0, 4), st.sampled_from(KINDS), st.booleans()), min_size=1, max_size=40),
       include_volume=st.booleans())
def test_cleanup_plan_follows_the_model(spark, ledger, include_volume):
    rows = [(r, k, KINDS.index(k) + 1, c) for r, k, c in ledger]
    df = spark.createDataFrame(rows, "run_id long, kind string, kind_order int, created_here boolean")
    got = sorted((r["run_id"], r["step_no"], r["kind"])
                 for r in op.cleanup_plan(df, include_volume=include_volume).collect())
    want = []
    for run in sorted({r for r, _, _ in ledger}):
        kinds = sorted({k for r, k, c in ledger if r == run and c and (include_volume or k != "volume")},
                       key=KINDS.index)
        want += [(run, i + 1, k) for i, k in enumerate(kinds)]
    assert got == sorted(want)


LINE = st.text(alphabet='ab1 "kN:e', max_size=25)


@SETTINGS
@given(lines=st.lists(LINE, min_size=1, max_size=30))
def test_text_operators_follow_python_re(spark, lines):
    import re

    df = spark.createDataFrame(list(enumerate(lines)), "id int, line string")
    pats = ["a", "b1"]
    got = sorted(r["id"] for r in op.match_lines(df, "line", pats).collect())
    assert got == [i for i, s in enumerate(lines) if all(re.search(p, s) for p in pats)]

    rules = [("ab", r"a+b", 0), ("one", r"(1)", 1), ("quote", r'"\w', 0)]
    got = {r["id"]: (r["pattern"], r["value"]) for r in op.first_pattern(df, "line", rules, keep=["id"]).collect()}
    want = {}
    for i, s in enumerate(lines):
        want[i] = (None, None)
        for name, p, g in rules:
            m = re.search(p, s)
            if m:
                want[i] = (name, m.group(g))
                break
    assert got == want

    got = sorted((r["id"], r["value"]) for r in op.extract_named_value(df, ["id"], "line", "N").collect())
    pat = r'"N": "(\w+)"'
    assert got == [(i, re.search(pat, s).group(1)) for i, s in enumerate(lines) if re.search(pat, s)]
