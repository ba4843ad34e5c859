"""Conversation trie against a plain one, deep, wide and odd tables."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from railflow.llm import trie as T

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """The contract, turn by turn."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, tie, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = own.get(base, [])[:h] + ts[h:]
    members = defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) if children[node] else 1
        own_saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own_saved + sum(saved[c] for c in children[node])
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
                    leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("local", [1, 6, T.LOCAL])
def test_against_plain_trie(spark, local):
    rng = random.Random(local)
    rows = []
    for c in rng.sample(range(-20, 60), 40):
        for turn in range(rng.randint(1, 12)):
            rows.append((c, rng.choice([turn, turn, turn, None]), rng.choice(["user", None, ""]), rng.choice(["a", "é", "", None])))
    got = T.conversation_trie(frame(spark, rows).repartition(5), local)
    assert rows_of(got) == plain(rows)


def test_deep_and_wide(spark):
    rows = [(0, t, "user", f"t{t % 3}") for t in range(3000)]                     # one deep conversation
    rows += [(5 * c, t, "user", f"t{t % 3}") for c in range(1, 60) for t in range(rng_length(c))]   # copies of its start
    rows += [(5 * c, 0, "user", str(c)) for c in range(100, 400)]                 # many children of the root
    got = T.conversation_trie(frame(spark, rows).repartition(4), 500)
    assert rows_of(got) == plain(rows)


def rng_length(c):
    return random.Random(c).randint(1, 40)


def test_settle_on_random_trees():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(1, 40)
        parent = [-1] + [rng.randint(max(0, i - rng.choice([1, 3, 40])), i - 1) for i in range(1, n)]
        depth = [0] * n
        for i in range(1, n):
            depth[i] = depth[parent[i]] + 1
        order = sorted(range(n), key=lambda i: depth[i])
        at = {u: i for i, u in enumerate(order)}
        parents = [at.get(parent[u], -1) for u in order]
        value, weight = [rng.randint(0, 9) for _ in order], [rng.randint(1, 4) for _ in order]
        total, heavy = value[:], weight[:]
        for i in range(n - 1, 0, -1):
            total[parents[i]] += total[i]
            heavy[parents[i]] += heavy[i]
        assert T.settle(parents, heavy, [(v,) for v in value]) == [[t] for t in total]


def test_one_node_ends_many_conversations(spark, monkeypatch):
    monkeypatch.setattr(T, "IDS", 7)
    rows = [(5 * c, 0, "user", "same") for c in range(100)]
    ends = frame(spark, rows).selectExpr("'n' AS node", "conv_id").repartition(3)
    got = T.ending_digests(ends).collect()
    assert [r.ends_sha256 for r in got] == [hashlib.sha256(",".join(str(5 * c) for c in range(100)).encode()).hexdigest()]


def test_odd_tables(spark):
    rows = [(None, 0, "user", "x"), (3, None, None, None), (3, None, None, None), (3, 2, "user", "y" * 100_000), (8, 1, "user", None)]
    df = frame(spark, rows)
    clash = df.selectExpr("*", "1 AS at", "2 AS n", "3 AS block", "4 AS node", "5 AS pos", "6 AS _bucket", "7 AS rid")
    assert rows_of(T.conversation_trie(clash)) == plain(rows)
    assert T.conversation_trie(df.limit(0)).collect() == []
    assert T.conversation_trie(df.where("conv_id IS NULL")).collect() == []
