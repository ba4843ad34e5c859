"""Star schema: ``dim_station, dim_train, dim_date, dim_time`` with dense
surrogate keys in natural-key order, and ``fact_train_movements`` with four
foreign keys, filled by first-writer-wins inserts and last-writer updates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railflow.operators.fold import fold_changes
from railflow.operators.index import with_dense_key
from railflow.operators.merge import first_wins, with_delays
from railflow.operators.names import DEFAULT_PREFIX, lookup_table, resolve_names

TRAIN_KEY = ["filter_flags", "trip_type", "owner", "trip_category", "train_number",
             "origin_station", "destination_station"]
TIME_FORMAT = "HH:mm:ss"


def dim_station(stations: DataFrame) -> DataFrame:
    """``station_id`` + the station columns, keyed in ``eva_number`` order."""
    return with_dense_key(stations, ["eva_number", "name"], "station_id")


def dates_of(trips: DataFrame, ts_col: str = "trip_start") -> DataFrame:
    return trips.select(F.to_date(ts_col).alias("date")).filter(F.col("date").isNotNull()).distinct()


def times_of(trips: DataFrame, ts_col: str = "trip_start") -> DataFrame:
    """Times of day as ``HH:mm:ss`` text (Spark has no TIME type by default)."""
    return (trips.select(F.date_format(ts_col, TIME_FORMAT).alias("time"))
            .filter(F.col("time").isNotNull()).distinct())


def dim_date(trips: DataFrame, ts_col: str = "trip_start") -> DataFrame:
    return with_dense_key(dates_of(trips, ts_col), ["date"], "date_id")


def dim_time(trips: DataFrame, ts_col: str = "trip_start") -> DataFrame:
    return with_dense_key(times_of(trips, ts_col), ["time"], "time_id")


def dim_train(planned: DataFrame) -> DataFrame:
    """Distinct 7-column train label; NULLs compare equal (one row for
    labels that differ only in which fields are missing)."""
    return with_dense_key(planned.select(*TRAIN_KEY).distinct(), TRAIN_KEY, "train_id")


def with_date_time_keys(trips: DataFrame, dates: DataFrame, times: DataFrame,
                        ts_col: str = "trip_start") -> DataFrame:
    """Attach ``date_id`` and ``time_id``.  Both dimensions are bounded by
    the calendar (days of the collection period; at most 86,400 times of
    day), so they are broadcast."""
    keyed = trips.withColumn("_date", F.to_date(ts_col)).withColumn("_time", F.date_format(ts_col, TIME_FORMAT))
    keyed = keyed.join(F.broadcast(dates.withColumnRenamed("date", "_date")), "_date", "left")
    keyed = keyed.join(F.broadcast(times.withColumnRenamed("time", "_time")), "_time", "left")
    return keyed.drop("_date", "_time")


def apply_changes(planned: DataFrame, changes: DataFrame) -> DataFrame:
    """Last-writer-wins update of the planned stops by their changes:
    changed times and platform take the last non-NULL value, cancellation
    is sticky, delays are recomputed.  ``planned`` must be one row per stop."""
    return apply_folded(planned, fold_changes(changes, "last"))


def apply_folded(planned: DataFrame, folded: DataFrame) -> DataFrame:
    """The update by changes that are already folded, one row per stop."""
    folded, p = folded.alias("c"), planned.alias("p")
    j = p.join(folded, F.col("p.stop_id") == F.col("c.stop_id"), "left")
    updated = j.select(
        "p.*",
        F.col("c.changed_arrival_time"), F.col("c.changed_departure_time"),
        F.col("c.changed_platform"),
        (F.coalesce(F.col("p.cancelled"), F.lit(False))
         | F.coalesce(F.col("c.cancelled"), F.lit(False))).alias("_cancelled"),
    ).drop("cancelled").withColumnRenamed("_cancelled", "cancelled")
    return with_delays(updated)


FACT_COLUMNS = ["stop_id", "station_id", "train_id", "date_id", "time_id",
                "planned_arrival_time", "planned_departure_time", "changed_arrival_time",
                "changed_departure_time", "arrival_delay_minutes", "departure_delay_minutes",
                "cancelled", "planned_platform", "changed_platform"]


def build_fact(planned: DataFrame, changes: DataFrame, stations_dim: DataFrame, trains: DataFrame,
               dates: DataFrame, times: DataFrame, trip_start_col: Column | None = None,
               prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """``fact_train_movements``.

    ``planned``: planned rows (first one per ``stop_id`` wins, in snapshot
    order); ``changes``: change rows (``star`` platform rule).
    ``trip_start_col`` defaults to the trip start embedded in ``stop_id``."""
    from railflow.functions.timefmt import trip_start
    start = trip_start_col if trip_start_col is not None else trip_start("stop_id")
    first = first_wins(planned, ["stop_id"], ["snapshot_ts", "member"])
    # changes first, while the stops are still partitioned by stop_id
    changed = apply_changes(first.withColumn("trip_start", start), changes)
    return with_foreign_keys(changed, stations_dim, trains, dates, times, prefix).select(*FACT_COLUMNS)


def with_foreign_keys(rows: DataFrame, stations_dim: DataFrame, trains: DataFrame, dates: DataFrame,
                      times: DataFrame, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """Attach station_id, train_id, date_id and time_id to planned rows with
    a ``trip_start``."""
    rows = resolve_names(rows, "station_name",
                         lookup_table(stations_dim, "name", "station_id"), prefix, "station_id")
    cond = [rows[c].eqNullSafe(trains[c]) for c in TRAIN_KEY]
    rows = rows.join(trains, cond, "left").select(rows["*"], trains["train_id"])
    return with_date_time_keys(rows, dates, times)
