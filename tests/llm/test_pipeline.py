"""The pipeline's stages, each on what the one before kept."""

from collections import Counter

import pytest

import corpus_pipeline
from railflow.llm import common

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["documents"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out[name] = docs.collect()
    return out


def test_stages(tables):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "lines", "near_duplicates", "mixing", "bpe"]
    columns = set(tables["documents"][0].asDict())
    for name in names[:-1]:
        assert tables[name] and set(tables[name][0].asDict()) == columns
    ids = {n: {r.doc_id for r in rows} for n, rows in tables.items()}
    for before, after in zip(["documents", *names], names):
        assert ids[after] <= ids[before]
    assert len(ids["quality"]) < len(ids["documents"]) and len(ids["near_duplicates"]) < len(ids["quality"])
    assert max(Counter(r.doc_id for r in tables["near_duplicates"]).values()) == 1
    assert all(r.n_chars == len(r.text) for r in tables["lines"])


def test_tokens_decode(tables):
    import public_tokenizers
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r.doc_id: r.text for r in tables["mixing"]}
    for r in tables["bpe"]:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_run_and_clean_up(spark, tables):
    before = len(common.staged_tables())
    got = corpus_pipeline.run(spark, SF)
    assert Counter((r.doc_id, r.ids_sha256) for r in got.collect()) == Counter(
        (r.doc_id, r.ids_sha256) for r in tables["bpe"])
    assert len(common.staged_tables()) <= before + 3


def test_empty_documents(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_texts_reach_python_in_small_batches(spark):
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows)
    try:
        for given, kept in (("10000", corpus_pipeline.BATCH_ROWS), ("0", corpus_pipeline.BATCH_ROWS), ("100", 100)):
            spark.conf.set(rows, given)
            docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
            assert corpus_pipeline.bpe_tokens(spark, docs, SF).count() == 1
            assert int(spark.conf.get(rows)) == kept
    finally:
        spark.conf.set(rows, before)


def test_last_stage_remembers_less(spark, monkeypatch):
    """Its workers stand beside the heap and the workers of earlier stages."""
    from railflow.llm import bpe, neardup
    given, encode = [], bpe.encode
    monkeypatch.setattr(bpe, "encode", lambda *a, **k: given.append(k) or encode(*a, **k))
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r.n_tokens for r in corpus_pipeline.bpe_tokens(spark, docs, SF).collect()}
    assert rows == {1: 2, 2: 0}
    assert given == [{"remembered": corpus_pipeline.REMEMBERED}] and corpus_pipeline.REMEMBERED <= 50_000
    assert neardup.KEPT_WORDS <= 100_000
