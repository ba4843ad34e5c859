"""Ranks and running sums over large ordered groups without a single-task window.

A group may hold a third of all rows, so its rows are first cut into ordered
buckets (about sqrt(n) of them).  Bucket totals are pre-aggregated, their
running sum gives each bucket's start, and only the rows of one bucket meet in
one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railflow.llm.common import fresh


def running_start(df: DataFrame, group: list[str], bucket: Column, order: list[Column],
                  amount: Column, name: str, total: str | None = None) -> DataFrame:
    """Add ``name``: the sum of ``amount`` over all earlier rows of the group.

    ``bucket`` must be a non-decreasing function of the order.  ``group``
    columns must not be null.  ``total`` optionally names a column with the
    sum over the whole group.  Ties in ``order`` are cut arbitrarily, so
    ``order`` should end with every column that the result shows.
    """
    bucket_, amount_, inside_, sum_, start_, total_ = (fresh(df, c) for c in ("bucket", "amount", "inside", "sum", "start", "total"))
    wanted = [*df.columns, name, *([total] if total else [])]
    df = df.withColumns({bucket_: bucket, amount_: amount})
    keys = [*group, bucket_]
    by_group = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    sums = df.groupBy(*keys).agg(F.sum(amount_).alias(sum_))
    starts = sums.select(
        *keys, (F.sum(sum_).over(by_group.orderBy(bucket_)) - F.col(sum_)).alias(start_),
        F.sum(sum_).over(by_group).alias(total_))
    inside = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(inside_, F.sum(amount_).over(
        inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col(amount_))
    out = out.join(starts, keys).withColumn(name, F.col(start_) + F.col(inside_))
    if total:
        out = out.withColumn(total, F.col(total_))
    return out.select(*[f"`{c}`" for c in wanted])
