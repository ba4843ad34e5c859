"""Near-dedup against all pairs by brute force."""

import random

import numpy as np
import pytest

from railflow.llm import neardup as N


def shingle_set(text, k):
    words = (text or "").encode().lower().split()
    k = min(k, len(words))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def brute(rows, k, percent):
    """rows: {doc_id: text} -> {doc_id: (n, component)}"""
    sets = {i: shingle_set(t, k) for i, t in rows.items()}
    root = {i: i for i in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(rows)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    p, q = sorted((find(i), find(j)))
                    root[q] = p
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(rng, words, n):
    words = words[:]
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10 ** 6)}"
    return words


@pytest.fixture(scope="module")
def corpus():
    """Chains of edits, a large group of copies, short and empty texts."""
    rng, rows = random.Random(3), {}
    for _ in range(25):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([4, 12, 60, 150, 400]))]
        for _ in range(rng.choice([1, 1, 2, 6, 14])):
            rows[len(rows)] = " ".join(words)
            words = edited(rng, words, max(1, len(words) // rng.choice([30, 60, 120])))
    base = [f"b{i}" for i in range(150)]
    for _ in range(120):
        rows[len(rows)] = " ".join(edited(rng, base, rng.choice([0, 0, 1, 3, 6, 9, 14])))
    for text in (None, "", " \n", "one", "one", "ONE", "two words", "Two\tWords", "a b c", "a b c d", "é É", "É é"):
        rows[len(rows)] = text
    return rows


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_components_by_brute_force(spark, corpus, k, percent):
    docs = spark.createDataFrame(list(corpus.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_duplicates(docs, k, percent).collect()}
    assert got == brute(corpus, k, percent)


def test_blocks_change_nothing(spark, corpus, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 7)
    docs = spark.createDataFrame(list(corpus.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_duplicates(docs, 3, 85).collect()}
    assert got == brute(corpus, 3, 85)


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60) if i != 30] + [(100, 90), (90, 95), (100, 90)]
    rows = N.components(spark.createDataFrame(edges, "a long, b long"), "test").collect()
    assert {r.node: r.label for r in rows} == {**{i: 0 if i <= 30 else 31 for i in range(61)}, 90: 90, 95: 90, 100: 90}
    assert N.components(spark.createDataFrame([], "a long, b long"), "test").collect() == []


def test_estimate_is_close():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.6, 0.85):
        n = 2000
        common = rng.integers(0, 2 ** 64, int(n * share), np.uint64)
        rest = [rng.integers(0, 2 ** 64, (n - len(common)) // 2, np.uint64) for _ in range(2)]
        a, b = (np.unique(np.concatenate([common, r])) for r in rest)
        true = len(common) / len(np.union1d(a, b))
        regs = N.sketches([a, b]).view(np.uint16).reshape(2, -1)
        assert abs(N.estimate(len(a), len(b), (regs[0] == regs[1]).sum()) - true) < 0.15


def test_odd_tables(spark):
    rows = [(1, "a b c d e f g", "x"), (1, "a b c d e f g", "x"), (None, "A b c d e f g", "y"), (None, None, "y"),
            (7, "other words in here now", None), (7, "a b c d e f g", None), (9, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = N.near_duplicates(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id is None, r.component_id or 0, r.kept)
                  for r in got) == sorted([
        (False, 1, 5, False, 1, True), (False, 1, 5, False, 1, True), (True, 0, 5, False, 1, False),
        (True, 0, 0, True, 0, True), (False, 7, 3, False, 7, True), (False, 7, 5, False, 1, False),
        (False, 9, 0, False, 9, True)])
    one = N.keep_one(docs)
    assert one.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in one.collect()) == [
        (False, 1, "a b c d e f g"), (False, 7, "other words in here now"), (False, 9, ""), (True, 0, "")]
    assert N.near_duplicates(docs.limit(0)).collect() == [] and N.keep_one(docs.limit(0)).collect() == []
