"""Token counts against the library of the tokenizer file."""

import os

import pytest

from railflow.llm import tokens

os.environ["TOKENIZERS_PARALLELISM"] = "false"

HARD = ["", " ", "a", "  lead", "trail \n\n", "a\x1c b'll don't  \n x", "é" * 70_000, "ab " * 50_000, "x" * 200_000,
        "\x85 \x85x y", "a　b  c   d", "<|endoftext|>x <|endoftext|> <|endoftext", "\t\t\r\n\x0b\x0c", "中文" * 300,
        "a   b " * 20_000]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def want(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def counted(texts, **kw):
    count, out = tokens.counter("byte_bpe_50k.tiktoken"), [0] * len(texts)
    for rows, parts in tokens.balanced(texts, kw.get("split", tokens.SPLIT_CHARS), kw.get("size", tokens.BATCH_BYTES)):
        for row, n in zip(rows, count(parts)):
            out[row] += n
    return out


def test_hard_texts(library):
    assert counted(HARD) == want(library, HARD)
    assert counted(HARD, split=7, size=50) == want(library, HARD)


def test_every_code_point(library):
    points = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}1{c} {c}{c}b '{c}." for c in points]
    assert counted(texts) == want(library, texts)


def test_forgetting_changes_nothing(library):
    small = tokens.PieceLengths(lambda ts: want(library, ts), keep=3)
    texts = ["one two three four five", "two two six seven eight", "one one"] * 3
    assert [small.counts([t])[0] for t in texts] == want(library, texts)


def test_query_rows(spark, library):
    rows = [(1, "some words here", "x"), (2, None, "x"), (None, "", "y"), (4, "word " * 2000, None), (4, "word " * 2000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")   # a clashing extra column
    got = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(df, "doc_id", "text").collect()}
    n = want(library, [r[1] for r in rows])
    assert got == {(r[0], len((r[1] or "").encode()), k, k > 1024) for r, k in zip(rows, n)}
    assert tokens.count_tokens(df, "doc_id", "text").count() == 5
    assert tokens.count_tokens(df.limit(0), "doc_id", "text").collect() == []


def test_sentencepiece_model(spark):
    import public_tokenizers
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    df = spark.createDataFrame([(1, "some  words here "), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(df, "doc_id", "text", "piece_bpe_32k.model").collect()}
    assert got == {1: len(model.encode("some  words here ")), 2: 0}
