"""Corpus pipeline: training-data stages applied to ``documents`` in turn.

1. quality: documents that the rules reject go.
2. lines: later repeats of passages go; a document of which nothing is left goes.
3. near_duplicates: one document of each group stays (5-word shingles, 0.8).
4. mixing: documents are taken by target weights, some in a second epoch.
5. bpe: texts become token ids; their decoding is digested.

Each stage takes the Parquet table that the stage before wrote.  Defined results for
odd rows are those of the operators; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railflow.llm import bpe, common, linededup, mixing, neardup, quality

K, PERCENT = 5, 80
BATCH_ROWS = 1000     # rows of texts that are held at once on their way to a Python worker, by JVM and worker
REMEMBERED = 40_000   # spellings in half a table of a worker in the last stage, where the heap of earlier ones is still held
BUDGET, MAX_EPOCHS = (9, 10), 2

_done: list[DataFrame] = []    # working tables of finished stages


def _tidy(before: list[DataFrame]) -> None:
    """Delete the working tables of the stage before (its result is written),
    and remember those of the present one."""
    common.unstage(*_done)
    _done[:] = [t for t in common.staged_tables() if not any(t is b for b in before)]


def _small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows: their buffers lie outside the heap,
    one or two for each task, and grow with the texts in a batch."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    before = common.staged_tables()
    out = quality.keep_good(docs, common.table(spark, sf_dir, "labels"))
    _tidy(before)
    return out


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    before = common.staged_tables()
    gone = common.fresh(docs, "n_removed")
    out = linededup.dedup_passages(docs, removed=gone)
    out = out.where((F.col(gone) == 0) | (F.btrim("text", F.lit(common.SPACE_CHARS)) != "")).drop(gone)
    out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    _tidy(before)
    return out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    before = common.staged_tables()
    out = neardup.keep_one(docs, K, PERCENT)
    _tidy(before)
    return out


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    before = common.staged_tables()
    out = mixing.mix(docs, budget=BUDGET, max_epochs=MAX_EPOCHS).select(*docs.columns)
    _tidy(before)
    return out


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    before = common.staged_tables()
    out = bpe.encode(docs, "text", remembered=REMEMBERED)
    _tidy(before)
    return out


STAGES = [
    ("quality", quality_rules),
    ("lines", line_dedup),
    ("near_duplicates", near_dedup),
    ("mixing", source_mixing),
    ("bpe", bpe_tokens),
]

ORACLE_SQL = None   # boosted trees and byte-pair encoding are not SQL; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result but the last is written to
    the shared folder and read again as the next stage's input."""
    docs, written = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        path = common.scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        written.append(path)
    for path in written[:-1]:
        common.delete(spark, path)
    return docs
