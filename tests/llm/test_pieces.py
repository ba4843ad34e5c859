"""Backtracking encoder and decoder against the sentencepiece library."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from railflow.llm import pieces as P


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(P.MODEL))


@pytest.fixture(scope="module")
def pieces():
    return P.vocabulary(P.MODEL)


def samples(pieces, n, seed=1):
    rng, known = random.Random(seed), sorted(pieces.ids)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEéèüß0123456789.,!?()[]{}<>#*▁  \t\n\x00中文字日本語\U0001F9FF́ﬁ�"
    kinds = [lambda: "".join(rng.choice(known).replace("▁", rng.choice(" ▁")) for _ in range(rng.randint(1, 12))),
             lambda: "".join(rng.choice(letters) for _ in range(rng.randint(0, 40))),
             lambda: "".join(rng.choice("aeinrst ") for _ in range(rng.randint(0, 60))),
             lambda: "".join(rng.choice("ab") for _ in range(rng.randint(0, 60))),
             lambda: "".join(rng.choice([" " * rng.randint(1, 50), "x", "the", "中", "\U0001F9FF", "<s>", "<0x41>"])
                             for _ in range(rng.randint(0, 10)))]
    return [rng.choice(kinds)() for _ in range(n)]


def test_encodes_and_decodes_as_the_library(library, pieces):
    for text in samples(pieces, 4000):
        ids = pieces.encode(text)
        assert ids == library.encode(text), text
        machine = P.Decoder(pieces)
        assert "".join([*map(machine.feed, ids), machine.end()]) == library.decode(ids)


def test_decodes_any_ids(library, pieces):
    rng = random.Random(2)
    for _ in range(2000):
        ids = [rng.randrange(0, rng.choice([300, 32000])) for _ in range(rng.randint(0, 12))]
        machine = P.Decoder(pieces)
        assert "".join([*map(machine.feed, ids), machine.end()]) == library.decode(ids), ids


def test_long_units_and_failed_positions(library, pieces):
    rng = random.Random(5)
    for text in ("".join(rng.choice("etaoinshrdlu") for _ in range(60_000)), "ab" * 40_000, "中" * 30_000, " " * 70_001, "=" * 5000):
        assert pieces.encode(text) == library.encode(text)
    small = P.Pieces({"a": 0, "b": 1, "ab": 2, "ba": 3, "aba": 4, "bab": 5}, {"a": -9., "b": -8., "ab": -3., "ba": -2., "aba": -1., "bab": -4.}, [], set(), -1)
    for n in range(1, 11):
        for word in range(1 << n):
            text = "".join("ab"[word >> i & 1] for i in range(n))
            assert small.backtrack(text) == small.merge([*text]), text


def test_parts(monkeypatch, library, pieces):
    text = " ".join(samples(pieces, 60, 9))
    for part in (1, 5, 100):
        monkeypatch.setattr(P, "PART", part)
        assert pieces.encode(text) == library.encode(text)


def test_table(spark, library, pieces):
    texts = samples(pieces, 300, 3) + [None, "", " ", "word " * 100_000]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "same", None, None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, `a b` int").repartition(3)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = sorted((-1 if r[0] is None else r[0], len(ids := library.encode(r[1] or "")), sha(",".join(map(str, ids))), sha(library.decode(ids))) for r in rows)
    got = P.encode_digests(docs, "doc_id", "text").collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    full = P.encode(docs, "text")
    assert full.columns == ["doc_id", "a b", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    texts_back = P.decode_ids(full, "ids").collect()
    assert {r.doc_id: r.text for r in texts_back if r.doc_id is not None} == {r[0]: library.decode(library.encode(r[1] or "")) for r in rows if r[0] is not None}
    assert P.encode_digests(docs.limit(0), "doc_id", "text").collect() == []


def test_plain_units_skip_the_character_scan(monkeypatch):
    model = P.vocabulary(P.MODEL)
    units = ["plain", "Straße", "x́y", "naïve,"]
    before = [(len(ids := model.unit(u)), ",".join(map(str, ids)), "".join(map(P.Decoder(model, inside=True).feed, ids)))
              for u in units if model._plain(u)]
    monkeypatch.setattr(model, "_known", {})
    monkeypatch.setattr(model, "_older", {})
    monkeypatch.setattr(model, "_characters", None)      # not called
    assert [model._spell(u) for u in units if model._plain(u)] == before and len(before) > 1
    machine = P.Decoder(model)
    machine.feed(model.ids["a"])
    assert machine.utf8 is None      # no byte, no byte decoder


def test_borders_of_pieces_as_by_merging_anew(pieces):
    """Undoing merges in their order says the same of two pieces as merging their characters."""
    rng, known = random.Random(11), sorted(pieces.reached)
    assert pieces._in_order
    starts = {}
    for p in known:
        starts.setdefault(p[0], []).append(p)
    apart = 0
    for k in range(20_000):
        left = rng.choice(known)
        right = rng.choice(starts[rng.choice(left[1:] or left)] if k % 2 else known)
        if not right.startswith(P.SPACE):
            want = pieces.merge([*left, *right]) == [left, right]
            assert pieces._apart(left, right) == want, (left, right)
            apart += want
    assert 5000 < apart < 20_000


def test_both_sides_of_a_unit_are_remembered(monkeypatch, library):
    """A word is spelled once, whatever signs follow it; signs in pieces with the character before are not cut off."""
    pieces = P.vocabulary(P.MODEL)
    monkeypatch.setattr(pieces, "_known", {})
    monkeypatch.setattr(pieces, "_older", {})
    monkeypatch.setattr(pieces, "_ends", {})
    texts = ["qwanth " + " ".join("qwanth" + end for end in (",", ".", "&&&", "12", "...", ")")), "x². ²,.. 中.9 \n., a\n!? \U0001F9FF. e.e. (.",
             "".join(chr(c) + "." for c in range(33, 0x2100)), "".join(f" {chr(c)}.,7 {chr(c)}{chr(c)}" for c in range(33, 0x600))]
    for text in texts:
        n, ids, decoded = P._digests(pieces, text, None)
        want = library.encode(text)
        assert (n, ids) == (len(want), hashlib.sha256(",".join(map(str, want)).encode()).hexdigest())
        assert decoded == hashlib.sha256(library.decode(want).encode()).hexdigest()
        if text is texts[0]:
            assert {*pieces._known} == {"qwanth"}
