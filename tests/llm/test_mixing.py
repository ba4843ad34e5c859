"""Mixing: budgets by an iterative brute force, selection by a plain pass."""

import hashlib
import math
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from railflow.llm import mixing as M

SF = "/root/testdata/sf0.01"


def h60(*parts):
    return int(hashlib.md5(":".join("~" if p is None else str(p) for p in parts).encode()).hexdigest()[:15], 16)


def fill(children, budget):
    """{name: share} by handing out shortages until nothing changes; children: {name: (capacity, weight)}."""
    open_, out = {k for k, (c, w) in children.items() if w > 0}, dict.fromkeys(children, 0)
    left = budget
    while open_:
        weight = sum(children[k][1] for k in open_)
        full = {k for k in open_ if left * children[k][1] >= children[k][0] * weight}
        if not full:
            for k in open_:
                out[k] = left * children[k][1] // weight
            break
        for k in full:
            out[k] = children[k][0]
        left -= sum(children[k][0] for k in full)
        open_ -= full
    return out


def brute(rows, budget, epochs, weights):
    """rows: (id, tokens, domain, lang, source) -> {(id, tokens, epoch): times}"""
    leaves = defaultdict(list)
    for r in rows:
        leaves[r[2:]].append(r)
    total = sum(r[1] for r in rows)
    cap = defaultdict(int)
    for leaf, own in leaves.items():
        for depth in range(4):
            cap[leaf[:depth]] += epochs * sum(r[1] for r in own)
    share = {(): min(total * budget[0] // budget[1], cap[()])}
    for depth, level in enumerate(M.LEVELS):
        for parent in {leaf[:depth] for leaf in leaves}:
            kids = {leaf[:depth + 1] for leaf in leaves if leaf[:depth] == parent}
            share |= fill({k: (cap[k], weights.get(level, {}).get(k[-1], 1)) for k in kids}, share[parent])
    out = defaultdict(int)
    for leaf, own in leaves.items():
        tokens = sum(r[1] for r in own)
        whole, rest = divmod(share[leaf], max(tokens, 1))
        start = 0
        for r in sorted(own, key=lambda r: (h60(M.SEED, whole, r[0]), -math.inf if r[0] is None else r[0], r[1])):
            for e in range(whole + (start < rest)):
                out[r[0], r[1], e] += 1
            start += r[1]
    return dict(out)


def spark_rows(df):
    out = defaultdict(int)
    for r in df.select("doc_id", "n_tokens", "epoch").collect():
        out[tuple(r)] += 1
    return dict(out)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, len((r.text or "").encode().split()), f"domain{h60('domain', r.source) % 4}", r.lang, r.source)
            for r in docs.collect()]
    for budget, epochs in (((3, 5), 2), ((3, 1), 2), ((1, 20), 1)):
        assert spark_rows(M.mix(docs, budget=budget, max_epochs=epochs)) == brute(rows, budget, epochs, M.WEIGHTS)


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("=a", "=x", "=1", 10), ("=a", "=x", "=2", 1000), ("=b", "=x", "=3", 1000)],
                                   "domain string, lang string, source string, tokens long")
    got = {r.source: r.target for r in M.leaf_budgets(leaves, (800, 2010), 1, {}).collect()}
    assert got == {"=1": 10, "=2": 390, "=3": 400}


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 4)), min_size=1, max_size=7), st.integers(0, 300))
def test_levels_fill_as_by_hand(spark, children, budget):
    kids = {f"=c{i}": c for i, c in enumerate(children)}
    nodes = spark.createDataFrame([(k, c, w, budget) for k, (c, w) in kids.items()],
                                  "name string, capacity long, weight long, budget long")
    got = {r.name: r.given for r in M.share_out(nodes, [], "name", "budget", "given").collect()}
    assert got == fill(kids, budget)


def test_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, epoch string, n_tokens int"
    rows = [(1, "a b c", None, "s", "e", 7), (1, "a b c", None, "s", "e", 7), (None, None, "en", None, None, None),
            (3, "w " * 5000, "en", "s", "e", 1), (4, "", "", "", "", 0)]
    docs = spark.createDataFrame(rows, schema)
    everything = M.mix(docs, budget=(1, 1), max_epochs=1, weights={})
    assert everything.columns[:6] == docs.columns and {"domain", "n_tokens_", "epoch_"} <= set(everything.columns)
    assert everything.where("doc_id = 1").count() == 2 and everything.where("doc_id = 3").count() == 1
    assert M.mix(docs.limit(0)).collect() == []
    assert M.mix(docs, weights={"source": {"s": 0}}).where(F.col("source") == "s").count() == 0


def test_clashing_helper_names(spark):
    names = ["domain_key", "lang_key", "source_key", "epochs", "rest", "order", "start", "bucket", "amount", "inside", "sum", "total",
             "_rest", "_epochs", "_start", "_order", "_domain", "_bucket", "_amount", "n_tokens", "epoch", "domain"]
    docs = spark.createDataFrame([(i, "a b c", "en", f"s{i % 3}") for i in range(30)], "doc_id long, text string, lang string, source string")
    plain = {(r.doc_id, r.epoch) for r in M.mix(docs).collect()}
    out = M.mix(docs.select("*", *[F.lit(n).alias(n) for n in names]))
    rows = out.collect()
    assert all(r[n] == n for r in rows for n in names)
    assert {(r.doc_id, r.epoch_) for r in rows} == plain
