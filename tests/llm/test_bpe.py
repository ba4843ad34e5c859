"""BPE transducer against the library of the tokenizer file."""

import hashlib
import os
import random

import pytest

from railflow.llm import bpe

os.environ["TOKENIZERS_PARALLELISM"] = "false"

HARD = ["", " ", "ab<|endoftext|>Cd <|startoftext|><|ENDOFTEXT|>", "Σας ΟΔΟΣ İI", "á ́b é", "x" * 30_000,
        "abcde" * 4000, "don't we'll'x 'S", "1234 ①²", "\x1cа\x85b c", "中文" * 5000, "aaaaab" * 3000, "the" * 9000,
        "\U0001F600" * 3000, "a　b c", "word " * 3000]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(bpe.TOKENIZER))


@pytest.fixture(scope="module")
def mine():
    return bpe.tokenizer(bpe.TOKENIZER)


def want(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_hard_texts(library, mine):
    for text in HARD:
        assert mine.encode(text) == want(library, text)


def test_every_code_point(library, mine):
    texts = [f"A{chr(c)}1{chr(c)} b" for c in range(0x34000) if not 0xD800 <= c < 0xE000]
    found = library.encode_batch(texts, add_special_tokens=False)
    assert [t for t, e in zip(texts, found) if mine.encode(t) != e.ids] == []


def test_streaming_equals_whole(mine):
    """Tokens emitted before the end of a word are those of the whole word."""
    rng, tokens = random.Random(5), [t for t in mine.spelling.values() if t.isascii() and t.isalpha()]
    small = bpe.Transducer(mine.merges, mine.transducer.lengths, step=1)
    for _ in range(12):
        word = "".join(rng.choice(tokens) for _ in range(400))
        symbols = [mine.inner[b] for b in word.encode()]
        symbols[-1] = mine.last[word.encode()[-1]]
        assert list(small.tokens(symbols)) == mine.merges.merge(symbols)


def test_lookahead_is_sufficient():
    """Over a small list every prefix agrees with every continuation beyond the lookahead."""
    vocab = {t: i for i, t in enumerate(["a", "b", "c", "ab", "bc", "abc", "ca", "cab", "aa", "aab"])}
    merges = [("b", "c"), ("a", "a"), ("a", "b"), ("c", "a"), ("a", "bc"), ("ca", "b"), ("a", "ab")]
    table = bpe.MergeList(vocab, merges)
    rng = random.Random(1)
    for _ in range(3000):
        whole = [rng.randrange(3) for _ in range(rng.randrange(1, 40))]
        cut = rng.randrange(1, len(whole) + 1)
        prefix, end = table.merge(whole[:cut]), 0
        full = table.merge(whole)
        text = {i: t for t, i in vocab.items()}
        for a, b in zip(prefix, full):
            end += len(text[a])
            if end > cut - table.lookahead:
                break
            assert a == b


def test_rejects_a_list_out_of_order():
    with pytest.raises(ValueError):
        bpe.MergeList({"a": 0, "b": 1, "ab": 2, "abb": 3}, [("ab", "b"), ("a", "b")])


def test_query_rows(spark, library):
    rows = [(1, "Some words, here!", 3), (2, None, 3), (None, "", 3), (4, "Word ça " * 2000, None),
            (4, "Word ça " * 2000, None), (5, HARD[2], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids_sha256 int")   # a clashing extra column
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = []
    for doc, text, _ in rows:
        ids = want(library, text)
        expected.append((doc, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    got = [tuple(r) for r in bpe.encode_digests(df, "doc_id", "text").collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert bpe.encode_digests(df.limit(0), "doc_id", "text").collect() == []


def test_ids_round_trip(spark):
    rows = [(1, "Hello world, ça va <|endoftext|> 😀"), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    back = {r.doc_id: r.text for r in bpe.decode_ids(bpe.encode(df, "text"), "ids").collect()}
    assert back == {1: "hello world , ça va <|endoftext|>😀", 2: "", 3: ""}


def test_decoder_holds_back_unfinished_bytes(mine):
    machine = bpe.ByteDecoder(mine)
    data = "é".encode()
    assert machine.feed(mine.inner[data[0]]) == ""
    assert machine.feed(mine.last[data[1]]) == "é "
    assert machine.feed(mine.inner[0xE2]) == "" and machine.end() == "�"


def test_words_are_remembered_over_two_generations(monkeypatch):
    import public_tokenizers
    monkeypatch.setattr(bpe, "KEPT", 3)
    model = bpe.WordTokenizer(public_tokenizers.path(bpe.TOKENIZER))
    first = [model.spelled_word(w) for w in ("alpha", "beta", "gamma", "delta")]
    real, merged = model.stream, []
    monkeypatch.setattr(model, "stream", lambda word: merged.append(word) or real(word))
    assert [model.spelled_word(w) for w in ("alpha", "delta")] == [first[0], first[3]] and not merged
    for numbers, text, n in first:
        ids = [*map(int, numbers.split())]
        one = bpe.SpellingDecoder(model.spelling)
        assert text == "".join(map(one.feed, ids)) and n == len(ids)
        both = bpe.SpellingDecoder(model.spelling)
        assert both.feed_all(ids) + both.feed_all([]) + both.feed_all(ids) == text + " " + text


def test_remembered_spellings_are_bounded():
    """Few remembered spellings, set before or after the tables have grown: the same results."""
    import public_tokenizers
    model = bpe.WordTokenizer(public_tokenizers.path(bpe.TOKENIZER))
    texts = [" ".join(f"word{i}x{j}, Plain{'abcdefghij'[j]}" for j in range(10)) + "!" for i in range(60)]
    want = [bpe._encoded(model, t, None) for t in texts]
    tables = lambda: [len(t) for t in (model._known, model._older, model._known_words, model._older_words)]
    assert max(tables()) > 25
    model.remember(25)
    assert max(tables()) <= 25
    for _ in range(2):
        assert [bpe._encoded(model, t, None) for t in texts] == want
        assert max(tables()) <= 25
