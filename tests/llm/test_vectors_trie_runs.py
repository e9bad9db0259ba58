"""op11, op12 and op13 against brute force."""

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablevault.llm import conversation_trie, embedding_dedup, periodic_runs, queries
from tests.llm.helpers import docs_of, prose, rows, with_clashes, words

# ------------------------------------------------------------------ op11

VECTORS = "vec_id long, embedding array<double>, label int"


def brute_links(rows_):
    """(id, n_links, component) of every row, all pairs compared."""
    good = {}
    for k, (i, v) in enumerate(rows_):
        ok = i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if ok:
            x = np.array(v, float) / np.abs(v).max()
            good[k] = x / np.linalg.norm(x)
    top = list(range(len(rows_)))

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    n = [0] * len(rows_)
    for a in good:
        for b in good:
            if a < b and len(good[a]) == len(good[b]) and good[a] @ good[b] >= 0.9:
                n[a] += 1
                n[b] += 1
                x, y = sorted((find(a), find(b)), key=lambda k: rows_[k][0])
                top[y] = x
    return [(rows_[k][0], n[k], rows_[find(k)][0]) for k in range(len(rows_))]


def near(rng, x, c):
    z = rng.normal(size=len(x))
    x = x / np.linalg.norm(x)
    z -= (z @ x) * x
    return (c * x + np.sqrt(1 - c * c) * z / np.linalg.norm(z)) * rng.uniform(0.1, 9)


def test_links_of_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = [rng.normal(size=24) for _ in range(60)]
    vectors += [near(rng, vectors[0], 0.97) for _ in range(120)]  # a group in which most, not all, are linked
    for _ in range(10):  # a chain
        vectors.append(near(rng, vectors[-1], 0.93))
    vectors += [near(rng, vectors[5], c) for c in (0.5, 0.8, 0.88)]
    vectors += [vectors[7]] * 30 + [vectors[7] * 2]
    vectors = [v.tolist() for v in vectors]
    odd = [None, [], [0.0] * 24, [-0.0] * 24, [None] + [1.0] * 23, [float("nan")] * 24, [float("inf")] + [0.0] * 23, [1.0],
           [2.0], [-1.0], [1e-200] * 24, [1e200] * 24, [1.0] * 25]
    rows_ = [(k + 10, v) for k, v in enumerate(vectors + odd)] + [(11, vectors[1]), (11, vectors[1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows_], VECTORS).repartition(5)
    got = embedding_dedup.near_vectors(with_clashes(df).withColumn("a.b", F.lit(1)))
    assert rows(got, "vec_id", "n_links", "component_id") == sorted(brute_links(rows_), key=str)
    assert got.where("kept <> (vec_id = component_id)").isEmpty()


def test_large_group_of_vectors_is_dealt_into_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = rng.normal(size=16)
    rows_ = [(k, near(rng, base, 0.96).tolist()) for k in range(700)]
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 128)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows_], VECTORS)
    want = {i: (n, c) for i, n, c in brute_links(rows_)}
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_vectors(df).collect()}
    missed = sum(want[i][0] - got[i][0] for i in want)
    assert all(got[i][0] <= want[i][0] for i in want)  # nothing below the threshold, nothing counted twice
    assert missed <= 0.005 * sum(n for n, _ in want.values())
    assert {c for _, c in got.values()} == {c for _, c in want.values()}


def test_links_in_buckets_come_out_as_a_forest(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=16)
    df = spark.createDataFrame([(k, near(rng, base, 0.995).tolist(), 0) for k in range(300)], VECTORS)
    classes = embedding_dedup.marked(df, "vec_id", "embedding").groupBy("mark").agg(
        F.min("id").alias("id"), F.count("*").alias("n"), F.first("vector").alias("vector"))
    likely = embedding_dedup.possible(embedding_dedup.coded(classes))
    out = embedding_dedup.links_in_buckets(likely, classes)
    assert out.count() <= likely.count() < 300 * embedding_dedup.bands(16) + 1  # rows, not the 44,850 pairs
    assert out.agg(F.sum("links")).first()[0] == 300 * 299


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 32))
    units = np.stack([v / np.linalg.norm(v) for a in x for v in (a, near(rng, a, 0.9))])
    turned, signs, factors = embedding_dedup.codes(units)
    scaled, even, odd = signs / np.sqrt(32) / factors[:, :, None], np.arange(0, 800, 2), np.arange(1, 800, 2)
    guess, error = embedding_dedup.pair_estimates(turned, scaled, even, odd), embedding_dedup.spreads(factors, 32)
    assert np.allclose(guess, np.diag(embedding_dedup.estimates(turned, scaled, even, odd)))
    off = guess - 0.9
    assert abs(off.mean()) < 0.01 and (np.abs(off) < embedding_dedup.SIGMAS * np.maximum(error[even], error[odd])).all()
    assert 0.5 < off.std() / error.mean() < 1.5


@pytest.mark.parametrize("kind", ["array<float>", "array<double>"])
def test_no_vectors(spark, kind):
    assert embedding_dedup.near_vectors(spark.createDataFrame([], f"vec_id long, embedding {kind}")).isEmpty()


# ------------------------------------------------------------------ op12

TURNS = "conv_id long, turn long, role string, text string"


def brute_trie(turns):
    convs = {}
    for c, t, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            convs.setdefault(c, []).append(((t is not None, t or 0), mark, (role, text)))
    convs = {c: [x for *_, x in sorted(ts)] for c, ts in convs.items()}
    rebuilt = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(convs.get(c - int(np.fmod(c, 100)), [])[:h] + own[h:])
    members = {}
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    out = []
    for node, cs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        ends = sorted(c for c in cs if rebuilt[c] == node)
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs),
                    sum(len(n) == len(node) + 1 for n in below),
                    sum(not any(len(m) == len(n) + 1 and m[:len(n)] == n for m in members) for n in below),
                    sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def built(df):
    return conversation_trie.trie(*conversation_trie.shared_openings(conversation_trie.turn_ids(df)))


def odd_conversations():
    rng = np.random.default_rng(2)
    turns = []
    for c in [*range(0, 30), *range(100, 140), *range(205, 215), -7, -150, -100, 10**12]:
        shape = rng.integers(0, 4)
        for t in range(int(rng.integers(1, 12))):
            text = f"turn {t} {shape}" if rng.random() < 0.8 else prose(int(rng.integers(99)), 3)
            turns.append((c, t, ["user", "assistant"][t % 2], text))
    for c in (300, 301, 302):  # many blocks, equal to far down
        turns += [(c, t, "user", f"é{t % 7}😀" if t < 40 + c - 300 else f"{c} {t}") for t in range(60)]
    turns += [(400, t, "u", "x") for t in range(8)] + [(500, t, "u", "x") for t in range(16)]  # whole blocks
    turns += [(600, None, None, None), (600, None, "", ""), (600, 0, "a", ""), (600, 0, "", "a"), (601, 3, "a", None), (601, 3, None, "a")]
    turns += [(None, 0, "user", "no id"), (600, 0, "a", "")]
    return turns


def test_trie_equals_brute_force(spark):
    turns = odd_conversations()
    df = spark.createDataFrame(turns, TURNS).repartition(7)
    assert rows(built(with_clashes(df).withColumn("a.b", F.lit(1))), *NODE) == brute_trie(turns)


def test_trie_of_copies_hashes_members_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "CHUNK_CHARS", 50)
    turns = [(c * 100, t, "user", f"t{t}") for c in range(500) for t in range(3)]  # each is its own base
    got = {r["depth"]: r for r in built(spark.createDataFrame(turns, TURNS).repartition(6)).collect()}
    assert sorted(got) == [0, 1, 2, 3] and got[3]["n_convs"] == 500 and got[3]["conv_id"] == 0
    assert got[3]["ends_sha256"] == hashlib.sha256(",".join(str(c * 100) for c in range(500)).encode()).hexdigest()
    assert got[0]["saved_tokens"] == 3 * 2 * 499 and got[0]["n_leaves"] == 1


def test_trie_without_conversations(spark):
    assert built(spark.createDataFrame([], TURNS)).isEmpty()
    assert built(spark.createDataFrame([(None, 1, "a", "b")], TURNS)).isEmpty()


def test_turnless_conversations_are_members_of_the_root(spark):
    short = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 5)
    turns = [(short, 0, "u", "gone")]
    assert rows(built(spark.createDataFrame(turns, TURNS)), *NODE) == brute_trie(turns) == [
        (short, 0, None, 1, 0, 1, 0, hashlib.sha256(str(short).encode()).hexdigest())]


# ------------------------------------------------------------------ op13


def brute_runs(w):
    n, out = len(w), {}
    for p in range(1, n // 3 + 1):
        i = p
        while i < n:
            j = i
            while j < n and w[j] == w[j - p]:
                j += 1
            s, length = i - p, j - i + p
            if j > i and length >= max(24, 3 * p):
                out[s, length] = min(p, out.get((s, length), p))
            i = max(j, i + 1)
    return sorted((s, n_, p) for (s, n_), p in out.items())


def with_repeats(seed):
    rng = np.random.default_rng(seed)
    w = rng.integers(0, int(rng.integers(1, 40)), int(rng.integers(0, 400)))
    for _ in range(rng.integers(0, 4)):
        if len(w) > 30:
            a = int(rng.integers(0, len(w) - 20))
            b, q = int(rng.integers(a + 10, len(w) + 1)), int(rng.integers(1, 60))
            for i in range(a, b):
                w[i] = w[a + (i - a) % q]
    return w


@pytest.mark.parametrize("seed", range(40))
def test_runs_of_words_equal_brute_force(seed):
    for k in range(10):
        w = with_repeats(seed * 100 + k).astype(np.int64)
        assert periodic_runs.runs_of(w, len(w)) == brute_runs(w.tolist())


def test_one_word_throughout_is_one_opening_per_stretch():
    w = np.zeros(200_000, np.int64)
    assert periodic_runs.runs_of(w, len(w)) == [(0, 200_000, 1)]
    places, _ = periodic_runs.openings(w, len(w))
    assert len(places) <= len(w) * np.log2(len(w)) / 2 + len(w)


def planted(doc_id, text):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    return w


def expected(doc_id, text):
    w = planted(doc_id, text)
    runs = brute_runs(w)
    stays = [True] * len(w)
    for s, n, p in runs:
        stays[s + p:s + n] = [False] * (n - p)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *shown, hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for x, k in zip(w, stays) if k).encode()).hexdigest())


def test_periodic_runs_equal_brute_force(spark, tmp_path):
    texts = [None, "", " \t\n", "one", "x " * 23, "x " * 24, "a b " * 11 + "a b", "é 😀 " * 40, prose(1, 900),
             *(" ".join(f"w{x}" for x in with_repeats(s)) for s in range(120)), *(prose(s, 150) for s in range(60))]
    texts += [texts[-1]] * 3 + ["\n".join([prose(3, 30)] * 5) + "\v end\f" + prose(4, 100)]
    docs = with_clashes(docs_of(spark, texts)).withColumn("a.b", F.lit(1))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_periodic_runs(spark, str(tmp_path))
    cols = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert rows(got, *cols) == sorted((expected(k, t) for k, t in enumerate(texts)), key=str)
    assert sum(r[1] for r in rows(got, *cols)) > 40


def test_runs_of_odd_tables(spark):
    assert periodic_runs.find_runs(docs_of(spark, ["x"]).limit(0)).isEmpty()
    twice = docs_of(spark, ["a " * 30, "a " * 30, "b"], ids=[1, 1, None])
    assert rows(periodic_runs.find_runs(twice), "doc_id", "n_words", "collapsed") == [(1, 30, "a"), (1, 30, "a"), (None, 1, "b")]
    long = docs_of(spark, ["k " + "p q r " * 200_000])
    r = periodic_runs.find_runs(long).first()
    assert r["collapsed"] == "k p q r" and [tuple(x) for x in r["runs"]] == [(1, 600_000, 3)]
