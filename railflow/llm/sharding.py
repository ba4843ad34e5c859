"""Operator 1, sharding: proportional stratified interleaving.

Rows of each source are put in a seeded random order and ranked; a row of
rank r in a source of n rows gets the fractional rank (r + 0.5) / n.  Sorted by
fractional rank the sources interleave in proportion, so equal cuts of that
order all show the mixture of the whole table.  The law is ``rows``: shard
sizes differ by one row at most.

Defined results: a null text has size 1 and the CRC of the empty text; null
sources form one stratum of their own; repeated rows are placed one by one
(identical rows are interchangeable); an empty table gives no rows; extra
columns are ignored.  The law takes no account of equal texts: a group larger
than a shard could not stay together under it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railflow.llm.common import HASH60, hash60, sqrt_buckets
from railflow.llm.ranking import running_start

SEED = 17


def interleave(df: DataFrame, source: str, keys: list[str], seed: int = SEED) -> DataFrame:
    """Add ``position`` (0-based) in the proportional interleaving of the
    sources.  ``keys`` identify a row; rows equal in all of them are
    interchangeable.  Only the named columns should be passed in: the rows
    are shuffled twice."""
    n = df.count()
    buckets = sqrt_buckets(n)
    out = df.withColumns({
        "_stratum": F.concat(F.lit("="), F.coalesce(F.col(source).cast("string"), F.lit(""))),
        "_order": hash60(F.lit(seed), F.col(keys[0]))})
    out = out.withColumn("_stratum", F.when(F.col(source).isNull(), "null").otherwise(F.col("_stratum")))
    out = running_start(out, ["_stratum"], F.expr(f"_order div {-(-HASH60 // buckets)}L"),
                        [F.col("_order"), *[F.col(k) for k in keys]], F.lit(1).cast("long"),
                        "_rank", total="_size")
    out = out.withColumn("_fraction", (F.col("_rank").cast("double") + 0.5) / F.col("_size").cast("double"))
    out = running_start(out, [], F.floor(F.col("_fraction") * buckets),
                        [F.col("_fraction"), F.col("_order"), F.col("_stratum"), *[F.col(k) for k in keys]],
                        F.lit(1).cast("long"), "position")
    return out.withColumn("n_rows", F.lit(n).cast("long")).drop(
        "_stratum", "_order", "_rank", "_size", "_fraction")


def shard(df: DataFrame, n_shards: int, source: str, keys: list[str], seed: int = SEED) -> DataFrame:
    """Add ``shard`` and ``slot`` (gapless from 0 in each shard)."""
    out = interleave(df, source, keys, seed)
    out = out.withColumn("shard", F.expr(f"int(position * {n_shards} div n_rows)"))
    first = F.expr(f"(shard * n_rows + {n_shards - 1}) div {n_shards}")
    return out.withColumn("slot", F.col("position") - first)


def shard_documents(docs: DataFrame, n_shards: int = 16, seed: int = SEED) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    out = shard(rows, n_shards, "source", ["doc_id", "text_crc32", "size"], seed)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "source")
