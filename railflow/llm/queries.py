"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railflow.llm import (
    bpe, fingerprints, importance, linededup, mixing, neardup, oracles, pieces, pii, quality, sharding, tokens, trie, urls,
)
from railflow.llm.common import table


def op1_shard_interleave(spark: SparkSession, d: str) -> DataFrame:
    return sharding.shard_documents(table(spark, d, "documents"))


def op2_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return tokens.count_tokens(table(spark, d, "documents"), "doc_id", "text")


def op3_quality_trees(spark: SparkSession, d: str) -> DataFrame:
    return quality.judge(table(spark, d, "documents"), table(spark, d, "labels"))


def op4_imatch_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, d, "documents"), whole=True)


def op5_bpe_transducer(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_digests(table(spark, d, "documents"), "doc_id", "text")


def op6_source_mixing(spark: SparkSession, d: str) -> DataFrame:
    """The mixture without its texts: one row per document and epoch."""
    return mixing.mix(table(spark, d, "documents")).select("doc_id", "domain", "lang", "source", "n_tokens", "epoch")


def op7_line_winnowing(spark: SparkSession, d: str) -> DataFrame:
    docs = linededup.dedup_passages(table(spark, d, "documents"))
    return docs.withColumn("n_chars", F.char_length("text").cast("long"))


def listed_urls(pages: DataFrame) -> DataFrame:
    """URLs to block: pages whose content lost its words to symbols (at least
    one in ten characters of the page's body text is a symbol)."""
    body = F.regexp_replace(F.coalesce("html", F.lit("")), "<[^>]*>|&[a-z]+;", "")
    symbols = F.length(body) - F.length(F.translate(body, "#*$%|", ""))
    return pages.where(symbols * 10 >= F.length(body)).where(F.length(body) > 0).select("url")


def op8_url_filter(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    return urls.judge(pages, listed_urls(pages))


def op9_pii_bootstrap(spark: SparkSession, d: str) -> DataFrame:
    return pii.find_personal_data(table(spark, d, "documents"))


def op10_hyperminhash_dedup(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, d, "documents"))


def op11_importance_resampling(spark: SparkSession, d: str) -> DataFrame:
    return importance.resample(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op12_conversation_trie(spark: SparkSession, d: str) -> DataFrame:
    return trie.conversation_trie(table(spark, d, "conversations"))


def op13_piece_backtracking(spark: SparkSession, d: str) -> DataFrame:
    return pieces.encode_digests(table(spark, d, "documents"), "doc_id", "text")


QUERIES = {
    "op1_shard_interleave": op1_shard_interleave,
    "op2_token_counts": op2_token_counts,
    "op3_quality_trees": op3_quality_trees,
    "op4_imatch_fingerprints": op4_imatch_fingerprints,
    "op5_bpe_transducer": op5_bpe_transducer,
    "op6_source_mixing": op6_source_mixing,
    "op7_line_winnowing": op7_line_winnowing,
    "op8_url_filter": op8_url_filter,
    "op9_pii_bootstrap": op9_pii_bootstrap,
    "op10_hyperminhash_dedup": op10_hyperminhash_dedup,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_piece_backtracking": op13_piece_backtracking,
}

ORACLE_SQL = {k: v for k, v in oracles.SQL.items() if k in QUERIES}
