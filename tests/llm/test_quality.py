"""Quality rules: brute-force statistics, held-out accuracy, monotonic scores."""

import re
from collections import Counter

import numpy as np
import pytest

from railflow.llm import quality as Q

SF = "/root/testdata/sf0.01"
HARD = [None, "", "  \n ", "a", "a b c d e " * 40, "one two three four five six seven eight nine ten",
        "x\n\nx\nx\n \n", "#*$%&|<>", "a\x0bb\x0cc\x1cd\xa0e", "q " * 30_000, "a b c d e f a b c d e g a b c d e"]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(i, i + 5))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)) if len(lines) < 500 else len(lines) - len(set(lines)),
            len(covered))


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_statistics_by_brute_force():
    for text in HARD:
        assert Q.measure(text)[0] == brute(text)


def test_query_on_table(tables):
    docs, labels = tables
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = Q.judge(docs, labels).collect()
    assert len(got) == len(texts)
    for r in got:
        base = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert base == brute(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_held_out_accuracy(tables):
    docs, labels = tables
    trees = Q.train(docs, labels.where("doc_id % 2 = 0"))
    rest = docs.join(labels.where("doc_id % 2 = 1"), "doc_id").select("quality", "text").collect()
    scores = trees.score(np.array([Q.measure(r.text)[1] for r in rest]))
    good = np.array([r.quality for r in rest]) == 1
    assert (scores[good] >= Q.THRESHOLD).mean() > 0.97
    assert (scores[~good] < Q.THRESHOLD).mean() > 0.9


def test_scores_are_monotonic(tables):
    trees = Q.train(*tables)
    rows = np.array([Q.measure(r.text)[1] for r in tables[0].limit(200).collect()])
    for f, sign in enumerate(Q.FEATURES.values()):
        if sign:
            scores = []
            for x in np.linspace(0, 1, 25):
                moved = rows.copy()
                moved[:, f] = x
                scores.append(trees.score(moved))
            assert (sign * np.diff(np.array(scores), axis=0) >= -1e-12).all()


def test_arrays_agree_with_a_walk(tables):
    trees = Q.train(*tables)
    row = np.array(Q.measure("Some plain text with a few words in it.")[1])
    total = trees.start
    for t in range(len(trees.feature)):
        node = 0
        while trees.left[t, node] != node:
            node = (trees.left if row[trees.feature[t, node]] <= trees.threshold[t, node] else trees.right)[t, node]
        total += trees.value[t, node]
    assert abs(trees.score(row[None])[0] - 1 / (1 + np.exp(-total))) < 1e-12


def test_odd_tables(spark):
    rows = [(i, t, "z", i) for i, t in enumerate(HARD)] + [(None, "plain words " * 6, None, 1), (3, "a", "z", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, quality int")
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    got = Q.judge(docs, labels).collect()
    assert len(got) == len(rows) and all(r.kept != r.base_failed and r.score is None for r in got)
    assert Q.keep_good(docs, labels).columns == docs.columns
    assert Q.judge(docs.limit(0), labels).collect() == []
    assert Q.train(docs, labels.limit(0)) is None
