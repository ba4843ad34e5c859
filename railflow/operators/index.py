"""Dense surrogate keys (1, 2, 3, ... in natural-key order) without a
single-partition window.

The rows are range-partitioned and sorted by the natural key (a
distributed sort), tagged with ``monotonically_increasing_id`` (partition
id in the upper bits, position in the lower 33) and checkpointed to the
session's reliable checkpoint folder so the tags are fixed even if tasks
are re-run.  Per-partition counts (one row per partition) give each
partition's offset; key = offset + position + 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railflow.session import ensure_checkpoint_dir

_LOW_BITS = (1 << 33) - 1


def with_dense_key(df: DataFrame, order_cols, key_name: str) -> DataFrame:
    order_cols = list(order_cols)
    ensure_checkpoint_dir(df.sparkSession)
    ordered = df.orderBy(*[F.col(c).asc_nulls_first() for c in order_cols])
    tagged = ordered.withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    tagged = tagged.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a window without partitioning is fine here
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    keyed = tagged.join(F.broadcast(offsets), "_pid")
    return keyed.select((F.col("_off") + F.col("_pos") + 1).alias(key_name), *df.columns)


def sorted_blocks(df: DataFrame, group: list[str], order: list[Column], block: str, blocks: int | None = None) -> DataFrame:
    """``df`` cut into blocks of neighbouring rows: range-partitioned by group and
    order, with the partition's number in ``block``, checkpointed so that the cut is
    fixed.  A group of any size is spread over as many blocks as its *rows* fill,
    whatever the values of the order; all rows of a block precede those of the next.
    ``blocks``: how many at most; Spark's number of shuffle partitions if not given."""
    ensure_checkpoint_dir(df.sparkSession)
    by = [*[F.col(g).asc() for g in group], *order]
    ordered = df.repartitionByRange(blocks, *by) if blocks else df.repartitionByRange(*by)
    return ordered.withColumn(block, F.spark_partition_id()).checkpoint(eager=True)


def with_position(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` plus the place (from 0) of each row in its group, in ``order``: counted
    inside blocks; a block starts after the rows of the group's blocks before it."""
    columns = [F.col(c).asc() for c in order]
    rows = sorted_blocks(df, group, columns, "_block")
    inside = F.row_number().over(Window.partitionBy(*group, "_block").orderBy(*columns))
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*group, "_block").agg(F.count(F.lit(1)).alias("_n")).select(
        *group, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rows = rows.withColumn("_inside", inside).join(starts, [*group, "_block"])
    return rows.select(*df.columns, (F.col("_start") + F.col("_inside") - 1).alias(name))
