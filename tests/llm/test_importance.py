"""Importance resampling against a plain computation."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from railflow.llm import importance as I


def plain(docs, target, percent=5, least=20):
    def feats(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]
    made = [(i, *feats(t)) for i, t in docs]
    s, t = Counter(b for _, _, f in made for b in f), Counter(b for x in target for b in feats(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    out = []
    for i, words, f in made:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(able[:percent * len(able) // 100], 1):
        row[4] = place
    return Counter(tuple(r) for r in out)


def rows_of(df):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"], r.n_words) for r in df.collect())


def texts(n, seed=1):
    rng = random.Random(seed)
    words = ["The", "cat", "Ärger", "x1", "naïve", "日本", "dog", "I'm", "a-b", "42", "e"] + [f"w{i}" for i in range(60)]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) + rng.choice(["", "\n", "."]) for _ in range(n)]


def test_against_plain_computation(spark):
    docs = list(enumerate(texts(400))) + [(400, None), (401, ""), (402, "the cat " * 5000)]
    target = texts(30, 2) + [None]
    got = I.resample(spark.createDataFrame(docs, "doc_id long, text string").repartition(6),
                     spark.createDataFrame([(t,) for t in target], "text string"))
    want = plain(docs, target)
    assert rows_of(got) == want
    assert sum(r[4] is not None for r in want) >= 10


def test_parts_do_not_change_features(monkeypatch):
    text = (" ".join(texts(20)) + "é" * 300 + " end" + "!" * 90 + "z" * 400).encode()
    whole = I.bucket_counts(text)
    for part in (1, 2, 7, 64, 333):
        monkeypatch.setattr(I, "PART", part)
        words, counts = I.bucket_counts(text)
        assert words == whole[0] and (counts == whole[1]).all()


def test_bit_sliced_sums_are_exact():
    rng = np.random.default_rng(4)
    gain = rng.integers(-20000, 15000, 1000).tolist()
    gain[:3] = [-32768, 32767, 0]
    counts = rng.integers(0, 4, (9, 1000)) * rng.integers(0, 2, (9, 1000))
    counts[3, 5], counts[4] = 10 ** 9, 0
    want = [int(sum(int(c) * g for c, g in zip(row, gain))) for row in counts]
    assert I.BitSlicedGains(gain).weights(counts) == want


def test_odd_tables(spark):
    rows = [(None, "a b " * 20, 1, 2, "x"), (None, "a b " * 20, 1, 2, "x"), (7, "a b " * 20, 1, 2, "x"), (7, "a b " * 20, 1, 2, "x"), (8, None, 1, 2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rid int, score int, weight string")
    none = spark.createDataFrame([], "text string")
    got = I.resample(docs, none, percent=100)
    assert rows_of(got) == plain([r[:2] for r in rows], [], 100)
    assert I.resample(docs.limit(0), none).collect() == []
