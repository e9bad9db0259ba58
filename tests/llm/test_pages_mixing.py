"""op8, op9 and the pipeline."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablevault.llm import decontaminate, mixing, near_dedup, quality_rules, queries, token_output, warc
from tablevault.llm.common import written
from tablevault.session import new_work_dir
from tests.conftest import SF_SMALL
from tests.llm.helpers import docs_of, prose, rows, with_clashes, words


def pages_of(spark, htmls, ids=None, urls=None):
    data = [(ids[k] if ids else k, urls[k] if urls else f"http://h/{k}", h) for k, h in enumerate(htmls)]
    return spark.createDataFrame(data, "page_id long, url string, html string").repartition(3)


def brute_records(pages):
    first = {}
    for page, html in pages:
        b = (html or "").encode()
        if len(b) >= 100 and page is not None:
            first[b] = min(first.get(b, page), page)
    out = []
    for page, html in pages:
        b = (html or "").encode()
        to = first.get(b)
        revisit = to is not None and to != page
        out.append((page, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return out


RECORD = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_archives_equal_brute_force(spark):
    long = prose(1, 40_000) + "é\r\n\r\nWARC/1.1\r\n"
    htmls = [None, "", "x" * 99, "x" * 99, "y" * 100, "y" * 100, "y" * 100, long, long, "\x00\r\n\r\n" * 60, "z" * warc.CHUNK_BYTES,
             "z" * (warc.CHUNK_BYTES + 1), "y" * 100, "q" * 120, "q" * 120, "q" * 120]
    ids = [40, 3, 9, 8, 7, 5, 6, 20, 2, 30, 31, 32, None, 50, 50, 51]
    urls = [None, "http://a b\nc", *[f"http://h/{k}" for k in range(len(ids) - 2)]]
    pages = with_clashes(pages_of(spark, htmls, ids, urls))
    got = rows(warc.written_and_read(pages), *RECORD)
    assert got == sorted(brute_records(list(zip(ids, htmls))), key=str)
    assert warc.written_and_read(pages_of(spark, [])).count() == 0


def test_chunks_of_the_archives_give_back_the_payloads(spark):
    htmls = [prose(1, 30_000), "short", "", prose(2, 20_000)]
    manifest = warc.write_archives(pages_of(spark, htmls), new_work_dir(spark, "warc"))
    assert sum(r["n_records"] for r in manifest.collect()) == 4
    parts = defaultdict(list)
    for r in warc.read_chunks(manifest).where("data is not null").collect():
        assert len(r["data"]) <= warc.CHUNK_BYTES
        parts[r["page_id"]].append((r["chunk_no"], bytes(r["data"])))
    assert {k: b"".join(d for _, d in sorted(v)).decode() for k, v in parts.items()} == {0: htmls[0], 1: "short", 3: htmls[3]}


def test_digests_run_on_over_batches(spark):
    text = prose(3, 5000).encode()
    df = spark.createDataFrame([(1, text), (2, b""), (3, text[:5])], "page_id long, payload binary")
    got = warc.chunk_digests(warc.as_chunks(df, "payload", 100), ["page_id"]).collect()
    assert {r["page_id"]: (r["payload_bytes"], r["payload_digest"]) for r in got} == {
        k: (len(b), hashlib.sha256(b).hexdigest()) for k, b in ((1, text), (2, b""), (3, text[:5]))}


def test_targets_are_shared_by_weight_up_to_the_cap(spark):
    sizes = {"a": 100, "b": 1000, "c": 10, None: 500, "d": 0, "é": 700}
    texts = [prose(k, n) for k, n in enumerate(sizes.values())]
    docs = docs_of(spark, texts, sources=list(sizes))
    got = {r["doc_id"]: r["target"] for r in mixing.placed(docs).collect()}
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    want, total, free = {}, 1.5 * sum(sizes.values()), set(names)
    while True:  # the excess is shared again until none is above
        level = (total - sum(want.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        want |= {s: 2 * sizes[s] for s in over}
        free -= over
    want |= {s: level * weight[s] for s in free}
    assert all(abs(got[k] - want[s]) < 1e-6 for k, s in enumerate(sizes))


def test_words_taken_come_near_the_targets_and_reruns_agree(spark):
    texts = [prose(s, 5 + s * 7 % 90) for s in range(400)] + [None, "", "one", "one"]
    sources = [["big", "big", "big", "mid", "small", None][k % 6] if k < 300 else "big" for k in range(404)]
    docs = with_clashes(docs_of(spark, texts, sources=sources, ids=[*range(402), 7, 7]))
    got = mixing.placed(docs).collect()
    assert len(got) == 404
    by, target, size = defaultdict(int), {}, {}
    source = {k: s for k, s in zip([*range(402), 7, 7], sources)}
    for r in got:
        s = source[r["doc_id"]]
        by[s] += r["taken"]
        target[s], size[s] = r["target"], r["source_size"]
        assert r["taken"] in (0, r["size"], 2 * r["size"]) and all(0 <= t <= 1 for t in r["positions"])
    assert all(abs(by[s] - target[s]) <= 48 for s in by)  # half of the longest document
    again = mixing.placed(docs.repartition(9))
    assert rows(again, "doc_id", "size", "taken") == sorted(((r["doc_id"], r["size"], r["taken"]) for r in got), key=str)
    assert mixing.placed(docs_of(spark, [])).count() == 0


def test_schedules_are_inverted(spark):
    for schedule in mixing.SCHEDULES:
        df = spark.range(101).select((F.col("id") / 100).alias("x")).withColumn("t", mixing.time_of(F.col("x"), schedule))
        got = [(r["x"], r["t"]) for r in df.collect()]

        def area(t):
            return sum((min(t, b) - a) * (wa + (wa + (wb - wa) * (min(t, b) - a) / (b - a))) / 2
                       for (a, wa), (b, wb) in zip(schedule, schedule[1:]) if t > a)

        assert all(abs(area(t) - x * area(1.0)) < 1e-9 for x, t in got)


def test_the_mix_repeats_documents_in_training_order(spark):
    docs = with_clashes(docs_of(spark, [prose(s, 50) for s in range(60)], sources=["a"] * 40 + ["b"] * 20))
    taken = {r["doc_id"]: len(r["positions"]) for r in mixing.placed(docs).collect()}
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    counts = defaultdict(int)
    for r in out.select("doc_id").collect():
        counts[r["doc_id"]] += 1
    assert counts == {k: n for k, n in taken.items() if n}


def training_order(spark, docs):
    """Ids of the copies as the training times ask for them."""
    times = [(t, r["doc_id"]) for r in mixing.placed(docs).collect() for t in r["positions"]]
    return [k for _, k in sorted(times)]


def test_token_files_hold_the_mix_in_training_order(spark):
    sources = [["a", "b", "c", None][s % 4] for s in range(240)]
    docs = with_clashes(docs_of(spark, [prose(s, 20 + s % 50) for s in range(240)], sources=sources))
    want = training_order(spark, docs)
    assert want != sorted(want) and len(set(want)) < len(want)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")  # several files
    try:
        mix = written(corpus_pipeline.mix(spark, docs, SF_SMALL), "mix")
        assert len(mix.inputFiles()) > 3
        got = corpus_pipeline.tokens(spark, mix, SF_SMALL).collect()
        manifest = token_output.write_tokens(mix, new_work_dir(spark, "tokens"), queries.tokenizer_file(),
                                             order=mixing.written_order(mix))
        ids = token_output.read_tokens(manifest).orderBy("start").collect()
    finally:
        spark.conf.set(coalesce, before)
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["place"])] == want == [r["id"] for r in ids]
    for start, order in (("place", "place"), ("start", "doc_id")):
        at = 0
        for r in sorted(got, key=lambda r: r[start]):
            assert r[start] == at
            at += r["n_tokens"]
        assert sorted(got, key=lambda r: r[start]) == sorted(got, key=lambda r: (r[order], r["place"]))


def test_schedules_reach_the_registered_positions(spark, monkeypatch):
    got = rows(queries.op9_mixing_positions(spark, SF_SMALL), "doc_id", "pass", "position")
    placed = mixing.placed(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).collect()
    assert got == sorted(((r["doc_id"], k, t) for r in placed for k, t in enumerate(r["positions"])), key=str)
    flat = (((0.0, 1.0), (1.0, 1.0)),) * 3
    monkeypatch.setattr(mixing.placed, "__defaults__", tuple(
        flat if d is mixing.SCHEDULES else d for d in mixing.placed.__defaults__))
    assert rows(queries.op9_mixing_positions(spark, SF_SMALL), "doc_id", "pass", "position") != got


def brute_pipeline(spark, docs, sf):
    """The stages' decisions, each taken from its operator's full result or from brute force."""
    good = {r["doc_id"] for r in quality_rules.quality(docs).where("kept").select("doc_id").collect()}
    docs = docs.where(F.col("doc_id").isin(list(good)))
    one = {r["doc_id"] for r in near_dedup.near_duplicates(docs).where("kept").select("doc_id").collect()}
    docs = docs.where(F.col("doc_id").isin(list(one)))
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    clean = {r["doc_id"] for r in decontaminate.find_matches(docs, bench).where("n_hit = 0").select("doc_id").collect()}
    docs = docs.where(F.col("doc_id").isin(list(clean)))
    return docs, {r["doc_id"]: len(r["positions"]) for r in mixing.placed(docs).collect()}


def test_pipeline_equals_its_stages_decisions(spark):
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    docs, taken = brute_pipeline(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet"), SF_SMALL)
    counts = defaultdict(int)
    for r in got:
        counts[r["doc_id"]] += 1
    assert counts == {k: n for k, n in taken.items() if n}
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])] == sorted(r["doc_id"] for r in got)
    assert all(words(r["text"]) for r in docs.collect())


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_empty_and_odd_tables(spark, name, stage):
    docs = with_clashes(docs_of(spark, [None, "", "x", prose(1, 60), prose(1, 60)], sources=[None, "a", "a", "b", "b"],
                                langs=[None, "en", "en", "en", "en"]))
    for table in (docs.where("false"), docs):
        out = stage(spark, table, SF_SMALL)
        out.collect()
        if name != "token_output":
            assert out.columns == docs.columns


def test_every_query_is_registered():
    import __spark_entry__ as E

    names = E.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in names and set(queries.ORACLE) <= set(queries.QUERIES)


def test_stages_pass_odd_columns_on(spark):
    texts = [" ".join(f"w{k}{j}" for j in range(80)) for k in range(12)]
    docs = docs_of(spark, texts).withColumns({"a.b": F.col("doc_id") * 2, "m": F.create_map(F.lit("k"), F.col("doc_id")),
                                              "nested": F.struct(F.create_map(F.lit(1), F.lit("x")).alias("deep"))})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, SF_SMALL), f"odd-{name}")
        assert out.columns == docs.columns and out.count() > 0
        assert out.where("`a.b` <> doc_id * 2 or m['k'] <> doc_id").isEmpty()
    assert corpus_pipeline.STAGES[-1][1](spark, out, SF_SMALL).count() > 0
