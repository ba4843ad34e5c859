"""Fold successive change snapshots into one record per stop.

Both policies are aggregations keyed by ``stop_id`` that Spark runs as partial
(map-side) + final aggregation, so a stop with very many snapshots is pre-reduced on
every mapper and never gathered into one buffer.  The text column (and ``max_by``)
has no fixed-width buffer, so Spark plans *sort* aggregates: each side sorts its
rows by ``stop_id`` once.

``fold_state`` / ``merge_deltas`` are the same folds in mergeable form: the state of
several loads together is the merge of their states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VALUE_COLUMNS = ("changed_arrival_time", "changed_departure_time", "changed_platform")
POLICIES = ("max", "last")


def fold_aggregations(policy: str = "max", order_cols=("snapshot_ts", "member")) -> list:
    """The aggregate Columns of a fold (shared by the batch and the
    streaming fold)."""
    if policy == "max":
        aggs = [F.max(c).alias(c) for c in VALUE_COLUMNS]
    elif policy == "last":
        order = F.struct(*[F.col(c) for c in order_cols])
        # max_by skips rows whose ordering is NULL: the ordering is nulled
        # where the value is NULL, so a trailing NULL never wins
        aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c)
                for c in VALUE_COLUMNS]
    else:
        raise ValueError(f"policy must be one of {POLICIES}, got {policy!r}")
    return aggs + [F.bool_or("cancelled").alias("cancelled")]


def fold_changes(changes: DataFrame, policy: str = "max", order_cols=("snapshot_ts", "member")) -> DataFrame:
    """``changes``: rows of ``sources.timetables.change_rows``.

    ``max``  largest changed times, largest platform text, any cancellation.
    ``last`` per column the last non-NULL value in ``order_cols`` order
             (a later NULL does not erase an earlier value); cancellation is
             sticky (once true, stays true).
    Result: ``stop_id, changed_arrival_time, changed_departure_time,
    cancelled, changed_platform``."""
    folded = changes.groupBy("stop_id").agg(*fold_aggregations(policy, order_cols))
    return folded.select("stop_id", "changed_arrival_time", "changed_departure_time",
                         "cancelled", "changed_platform")


def _with_places(rows: DataFrame, lasts: list, cancelled) -> DataFrame:
    """One (place, value) per value column and stop, taken apart: the last value of each
    with its place.  One buffer holds both, so a place is shuffled once."""
    packed = rows.groupBy("stop_id").agg(*[F.max(x).alias(f"_{c}") for c, x in zip(VALUE_COLUMNS, lasts)],
                                         cancelled.alias("cancelled"))
    return packed.select("stop_id", *[F.col(f"_{c}.value").alias(c) for c in VALUE_COLUMNS], "cancelled",
                         *[F.col(f"_{c}.at").alias(f"{c}_at") for c in VALUE_COLUMNS])


def fold_state(changes: DataFrame, policy: str = "max", order_cols=("snapshot_ts", "member")) -> DataFrame:
    """The fold with what a later merge needs: for ``last`` also the place
    (``<column>_at``) of each value; of values at one place the largest counts."""
    if policy == "last":
        at = F.struct(*[F.col(c) for c in order_cols]).alias("at")
        lasts = [F.when(F.col(c).isNotNull(), F.struct(at, F.col(c).alias("value"))) for c in VALUE_COLUMNS]
        return _with_places(changes, lasts, F.bool_or("cancelled"))
    return changes.groupBy("stop_id").agg(*fold_aggregations(policy, order_cols))


def merge_deltas(states: DataFrame, policy: str = "max") -> DataFrame:
    """One state per stop out of any number of ``fold_state`` results."""
    if policy == "max":
        return states.groupBy("stop_id").agg(*fold_aggregations("max"))
    lasts = [F.when(F.col(f"{c}_at").isNotNull(), F.struct(F.col(f"{c}_at").alias("at"), F.col(c).alias("value")))
             for c in VALUE_COLUMNS]
    return _with_places(states, lasts, F.bool_or("cancelled"))
