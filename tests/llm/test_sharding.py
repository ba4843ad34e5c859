"""Sharding: sizes, mixture and order."""

import zlib
from collections import Counter, defaultdict

from railflow.llm import sharding as S


def test_mixture_in_every_shard(spark):
    rows = [(i, "t" * (i % 7), "big" if i % 3 else f"s{i % 5}") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = S.shard_documents(docs).collect()
    assert sorted(r.doc_id for r in got) == list(range(1500))
    total, shards = Counter(r.source for r in got), defaultdict(list)
    for r in got:
        shards[r.shard].append(r)
    sizes = [len(shards[s]) for s in range(16)]
    assert max(sizes) - min(sizes) <= 1
    for own in shards.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
        count = Counter(r.source for r in own)
        assert all(abs(count[s] - n * len(own) / 1500) <= 2 for s, n in total.items())
    again = S.shard_documents(docs.repartition(3)).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in again} == {(r.doc_id, r.shard, r.slot) for r in got}
    other = S.shard_documents(docs, seed=5).collect()
    assert {(r.doc_id, r.shard) for r in other} != {(r.doc_id, r.shard) for r in got}


def test_odd_tables(spark):
    rows = [(None, None, None, 1), (None, None, None, 1), (3, "é", "a", 2), (3, "é", "a", 2), (4, "", "", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, shard int")
    got = S.shard_documents(docs, 2).collect()
    assert len(got) == 5 and sorted(Counter(r.shard for r in got).values()) == [2, 3]
    assert {(r.doc_id, r.size, r.text_crc32) for r in got} == {(None, 1, 0), (3, 3, zlib.crc32("é".encode())), (4, 1, 0)}
    assert S.shard_documents(docs.limit(0)).collect() == []
