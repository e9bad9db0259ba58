"""op1 and op10 against brute force."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from tablevault.llm import near_dedup, suffix_array, suffix_dedup
from tests.llm.helpers import docs_of, lower, prose, rows, with_clashes, words


def shingle_sets(texts):
    out = []
    for t in texts:
        w = words(lower(t))
        out.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def brute_components(ids, texts):
    sets, top = shingle_sets(texts), list(range(len(texts)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if union and 100 * both >= 75 * union:
                x, y = sorted((find(a), find(b)), key=lambda k: ids[k])
                top[y] = x
    return [(ids[k], len(sets[k]), ids[find(k)], find(k) == k) for k in range(len(texts))]


def near_texts():
    base = [prose(s, 120) for s in range(4)]
    texts = [None, "", " \t\n", "one two", "ONE two", "one", "a b c d e", *base, base[0], base[0].upper(), "x " * 50]
    rng = np.random.default_rng(5)
    for b in base[:3]:  # chains of copies with more and more changes
        w = b.split()
        for _ in range(8):
            w[rng.integers(0, len(w))] = "changed"
            texts.append(" ".join(w))
    return texts + [prose(9, 30_000), prose(9, 30_000) + " tail"]


def test_near_duplicates_equal_brute_force(spark):
    texts = near_texts()
    got = near_dedup.near_duplicates(with_clashes(docs_of(spark, texts)))
    want = brute_components(list(range(len(texts))), texts)
    assert rows(got, "doc_id", "n_shingles", "component_id", "kept") == sorted(want, key=str)
    stay = near_dedup.one_of_each(with_clashes(docs_of(spark, texts)))
    assert stay.first()["id"] == "clash"
    assert sorted(r["doc_id"] for r in stay.collect()) == [w[0] for w in want if w[3]]


def test_near_duplicates_of_odd_tables(spark):
    empty = docs_of(spark, [])
    assert near_dedup.near_duplicates(empty).count() == 0
    twice = docs_of(spark, ["a b c d e f", "a b c d e f", None, "q"], ids=[7, 7, 8, None])
    got = rows(near_dedup.near_duplicates(twice), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted([(7, 2, 7, True), (7, 2, 7, True), (8, 0, 8, True), (None, 1, None, False)], key=str)


def test_likelihood_estimates_the_overlap():
    rng = np.random.default_rng(1)
    common, own = rng.integers(0, 2**63, 600).astype(np.uint64), rng.integers(0, 2**63, 400).astype(np.uint64)
    a, b = np.concatenate([common, own[:200]]), np.concatenate([common, own[200:]])
    regs = near_dedup.sketches(np.concatenate([a, b]), np.repeat([0, 1], [800, 800]), np.array([800, 800]))
    merged = np.maximum(regs[0], regs[1])  # the sketch of the union
    both = np.unique(np.concatenate([a, b]))
    assert (near_dedup.sketches(both, np.zeros(len(both), int), np.array([len(both)]))[0] == merged).all()
    guess = near_dedup.likely_overlap(regs[:1], regs[1:], np.array([800.0]), np.array([800.0]))[0]
    assert abs(guess - 0.6) < 0.12


def test_components_of_a_long_chain(spark):
    from tablevault.llm.components import components

    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(50, 60), (60, 50), (70, 70)], "a long, b long")
    got = defaultdict(set)
    for r in components(links).collect():
        got[r["component"]].add(r["node"])
    assert got == {0: set(range(41)), 50: {50, 60}}


def brute_repeats(ids, texts):
    seen, out = set(), []
    for k in sorted(range(len(texts)), key=lambda k: (ids[k], texts[k] or "")):
        b = (texts[k] or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            if b[i:i + 100] in seen:
                gone[i:i + 100] = b"\1" * 100
            seen.add(b[i:i + 100])
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((ids[k], len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def repeat_texts():
    passage, other = prose(1, 60), prose(2, 60)
    return [None, "", "short", passage, "x" + passage, passage[7:] + other, other * 3, "a" * 1000, "a" * 350, "é" * 120 + "ü" * 90,
            "ü" * 95 + "é" * 130, prose(3, 40) + passage[20:140] + prose(4, 40), passage[:99], passage[:100], prose(5, 9000),
            prose(6, 20) + prose(5, 9000)[11_111:30_000]]


@pytest.mark.parametrize("cap", [4096, 1])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, cap):
    monkeypatch.setattr(suffix_dedup, "BATCH_CONTEXTS", cap)  # 1: all anchors take the other way
    texts = repeat_texts()
    got = suffix_dedup.remove_repeats(with_clashes(docs_of(spark, texts)))
    have = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest())
                  for r in got.collect())
    assert have == sorted(brute_repeats(list(range(len(texts))), texts))


def test_suffix_dedup_of_odd_tables(spark):
    assert suffix_dedup.remove_repeats(docs_of(spark, [])).count() == 0
    t = prose(1, 60)
    # a null id comes first; rows that are equal in id and text are one document
    got = suffix_dedup.remove_repeats(docs_of(spark, [t, t, t, "z" + t], ids=[None, 5, 5, 5]))
    n = len(t)
    assert rows(got, "doc_id", "n_bytes", "n_removed") == sorted([(None, n, 0), (5, n, n), (5, n, n), (5, n + 1, n)], key=str)


@pytest.mark.parametrize("cap", [4096, 1])
def test_rows_that_stand_twice_are_no_repeats_of_themselves(spark, monkeypatch, cap):
    monkeypatch.setattr(suffix_dedup, "BATCH_CONTEXTS", cap)
    texts = repeat_texts()
    texts += [t[30:] + "tail" for t in texts if t] + [t[:150] for t in texts if t]
    ids = list(range(len(texts)))
    want = {r[0]: r for r in brute_repeats(ids, texts)}
    got = suffix_dedup.remove_repeats(docs_of(spark, texts + texts[::2], ids=ids + ids[::2]))
    have = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest())
                  for r in got.collect())
    assert have == sorted(want[i] for i in ids + ids[::2])


def test_suffix_arrays_are_sorted_and_prefixes_exact():
    rng = np.random.default_rng(0)
    for _ in range(30):
        k = int(rng.integers(1, 5))
        parts = [np.append(rng.integers(1, 1 + k, int(rng.integers(1, 150))), 0) for _ in range(int(rng.integers(1, 5)))]
        text = np.concatenate([*parts, parts[0]]).astype(np.uint8)
        order, raw = suffix_array.suffix_array(text), bytes(text)
        assert sorted(order.tolist()) == list(range(len(text)))
        heads = [raw[i:i + suffix_array.DEPTH] for i in order]
        assert all(a <= b for a, b in zip(heads, heads[1:]))
        shared = suffix_array.common_prefixes(text, order, 100)
        for x in range(1, len(order)):
            a, b = raw[order[x - 1]:][:100], raw[order[x]:][:100]
            m = next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))
            assert shared[x] == m


def test_only_small_suffixes_are_sorted_directly(monkeypatch):
    seen, real = [], suffix_array.sorted_directly
    monkeypatch.setattr(suffix_array, "sorted_directly", lambda text, places: (seen.append(places), real(text, places))[1])
    text = np.frombuffer(prose(7, 3000).encode() + b"\0", np.uint8)
    suffix_array.suffix_array(text)
    raw = bytes(text)
    assert len(seen) == 1 and len(seen[0]) < 0.6 * len(text)
    assert all(raw[i:i + 200] < raw[i + 1:i + 201] or i == len(raw) - 1 for i in seen[0].tolist())


def test_contexts_hold_every_string_once():
    text = prose(3, 400).encode()
    data, offsets = np.frombuffer(text, np.uint8), np.array([0, 50, 50, 149, 1000, len(text)])
    f = suffix_dedup.contexts(data, offsets)
    starts = sorted((r, s + k) for r, s, n in zip(f["row"], f["start"], f["n"]) for k in range(n))
    assert starts == [(r, s) for r in range(5) for s in range(max(0, offsets[r + 1] - offsets[r] - 99))]
