"""Planned stops + folded changes -> train movements (the Parquet path),
first-writer-wins dedupe and the unmatched-change quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railflow.functions.timefmt import minutes_between
from railflow.schemas import MOVEMENT_COLUMNS


def with_delays(df: DataFrame) -> DataFrame:
    """Arrival/departure delay in whole minutes (truncated toward zero),
    only where both the planned and the changed time are known."""
    return df.select(
        "*",
        minutes_between("planned_arrival_time", "changed_arrival_time").alias("arrival_delay_minutes"),
        minutes_between("planned_departure_time", "changed_departure_time").alias("departure_delay_minutes"),
    )


def merge_movements(planned: DataFrame, folded: DataFrame) -> DataFrame:
    """Left join of planned stops with one folded change per stop.

    ``planned`` needs ``eva_number`` (see ``names.resolve_names``).  Every
    planned row is kept (one per snapshot it was seen in); changes update
    the changed columns; cancellation is the OR of both sides."""
    p = planned.alias("p")
    c = folded.alias("c")
    joined = p.join(c, F.col("p.stop_id") == F.col("c.stop_id"), "left")
    merged = joined.select(
        F.col("p.snapshot_date"), F.col("p.snapshot_hour"), F.col("p.snapshot_minute"),
        F.col("p.stop_id"), F.col("p.station_name"), F.col("p.filter_flags"),
        F.col("p.trip_type"), F.col("p.owner"), F.col("p.eva_number"),
        F.col("p.trip_category"), F.col("p.train_number"), F.col("p.origin_station"),
        F.col("p.destination_station"), F.col("p.planned_arrival_time"),
        F.col("p.planned_departure_time"),
        F.col("c.changed_arrival_time"), F.col("c.changed_departure_time"),
        (F.coalesce(F.col("p.cancelled"), F.lit(False))
         | F.coalesce(F.col("c.cancelled"), F.lit(False))).alias("cancelled"),
        F.col("p.planned_platform"), F.col("c.changed_platform"),
    )
    return with_delays(merged).select(*MOVEMENT_COLUMNS)


def first_wins(rows: DataFrame, key_cols, order_cols, existing: DataFrame | None = None) -> DataFrame:
    """One row per key: the first in ``order_cols`` order (then by the other
    columns, so the choice is total).  Rows whose key is already in
    ``existing`` are dropped (insert ... on conflict do nothing).

    Implemented as ``min(struct(order, payload))`` per key, with map-side
    pre-reduction, so a hot key never forms a single sorted window partition
    (a struct has no fixed-width buffer: Spark plans sort aggregates)."""
    key_cols, order_cols = list(key_cols), list(order_cols)
    rest = [c for c in rows.columns if c not in key_cols and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in order_cols + rest]).alias("_first")
    first = rows.groupBy(*key_cols).agg(F.min(packed).alias("_first"))
    out = first.select(*key_cols, *[F.col(f"_first.{c}").alias(c) for c in order_cols + rest])
    out = out.select(*rows.columns)
    if existing is not None:
        out = out.join(existing.select(*key_cols), key_cols, "left_anti")
    return out


def unmatched_changes(changes: DataFrame, planned: DataFrame) -> DataFrame:
    """Changes whose ``stop_id`` has no planned stop, every one of them
    (also cancel-only and platform-only changes; ``has_time`` marks the
    ones carrying a changed time)."""
    keys = planned.select("stop_id")
    return as_unmatched(changes.join(keys, "stop_id", "left_anti"))


def as_unmatched(changes: DataFrame) -> DataFrame:
    """What is kept of changes without a planned stop."""
    return changes.select(
        "stop_id", "station_name", F.col("eva_raw").alias("eva_number"), "snapshot_ts",
        "changed_arrival_time", "changed_departure_time", "cancelled", "changed_platform",
        "has_time")
