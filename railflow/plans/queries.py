"""The eight named queries.  Each takes DataFrames and parameters and
returns a lazy DataFrame; parameters are bound as literals, never pasted
into SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def delays_long(movements: DataFrame, *keep: str) -> DataFrame:
    """Arrival and departure delays as one column (one scan, ``stack``),
    NULL delays dropped.  Adds ``kind`` = arrival | departure."""
    stacked = movements.select(
        *keep,
        F.stack(F.lit(2),
                F.lit("arrival"), F.col("arrival_delay_minutes"),
                F.lit("departure"), F.col("departure_delay_minutes")).alias("kind", "delay_minutes"))
    return stacked.filter(F.col("delay_minutes").isNotNull())


DAILY_AVG_SQL = """
SELECT snapshot_date, station_name, AVG(delay_minutes) AS avg_delay_minutes
FROM (SELECT snapshot_date, station_name,
             stack(2, arrival_delay_minutes, departure_delay_minutes) AS delay_minutes
      FROM {movements}
      WHERE station_name = :station)
WHERE delay_minutes IS NOT NULL
GROUP BY snapshot_date, station_name
ORDER BY snapshot_date
"""


def daily_avg_delay_sql(movements: DataFrame, station: str) -> DataFrame:
    """Q5 in SQL text: the DataFrame is passed in (no global temp view) and
    the station is a bound parameter, never pasted into the text."""
    return movements.sparkSession.sql(DAILY_AVG_SQL, args={"station": station}, movements=movements)


def between_dates(movements: DataFrame, dates: tuple[str, str] | None, column: str = "snapshot_date") -> DataFrame:
    """Rows whose snapshot date lies in ``dates`` (first, last; both included).  The
    date is a folder column of the stored fact: only those folders are read."""
    if dates is None:
        return movements
    first, last = (F.lit(str(d)).cast("date") for d in dates)
    return movements.filter(F.col(column).between(first, last))


def daily_avg_delay(movements: DataFrame, station: str, dates: tuple[str, str] | None = None, resolve: bool = False,
                    stations: DataFrame | None = None, prefix: str = "") -> DataFrame:
    """Q5: average delay per snapshot date for one station, within ``dates`` if given.

    The name is matched exactly; with ``resolve`` it may be loosely spelled and stands
    for a station of ``stations``, whose stops count whatever their own spelling."""
    movements = between_dates(movements, dates)
    if resolve:
        one = resolve_station(stations, station, prefix).select(F.col("eva_number"), F.col("name").alias("_name"))
        at = movements.join(F.broadcast(one), "eva_number").withColumn("station_name", F.col("_name"))   # one row
    else:
        at = movements.filter(F.col("station_name") == F.lit(station))
    per_day = (delays_long(at, "snapshot_date", "station_name")
               .groupBy("snapshot_date", "station_name")
               .agg(F.avg("delay_minutes").alias("avg_delay_minutes")))
    return per_day.orderBy("snapshot_date")


# --------------------------------------------------------------- Q1 .. Q4, Q6

def _name_hits(stations: DataFrame, raw_name: str, prefix: str) -> DataFrame:
    """Stations whose name is one of the four spellings of ``raw_name``,
    with the spelling's priority in ``_rank`` (1 = exact)."""
    from railflow.operators.names import candidate_names
    cands = candidate_names(F.lit(raw_name), prefix)
    return (stations.select("*", F.array_position(cands, F.col("name")).alias("_rank"))
            .filter(F.col("_rank") > 0))


def resolve_station(stations: DataFrame, raw_name: str, prefix: str, id_col: str = "eva_number") -> DataFrame:
    """The one station a loosely spelled name stands for (first present
    spelling; a repeated name keeps its largest id).  0 or 1 row."""
    hits = _name_hits(stations, raw_name, prefix)
    return hits.orderBy(F.col("_rank").asc(), F.col(id_col).desc()).limit(1).drop("_rank")


def station_by_name(stations: DataFrame, raw_name: str, prefix: str) -> DataFrame:
    """Q1: ``name, longitude, latitude, identifier`` of a loosely spelled station."""
    return resolve_station(stations, raw_name, prefix).select(
        "name", "longitude", "latitude", F.col("eva_number").alias("identifier"))


def cancelled_in_snapshot(movements: DataFrame, date: str, hour: int) -> DataFrame:
    """Q3 by the snapshot's clock: cancelled stops of the snapshots taken on ``date``
    in ``hour``, from the wide fact, of which only these snapshots' folders are read."""
    hits = between_dates(movements, (date, date)).filter((F.col("snapshot_hour") == F.lit(int(hour))) & F.col("cancelled"))
    return hits.agg(F.count(F.lit(1)).alias("cancelled_movements"))


def cancelled_at(fact: DataFrame, dates: DataFrame | None, times: DataFrame | None, date: str, hour: int,
                 clock: str = "trip_start") -> DataFrame:
    """Q3: number of cancelled stops on ``date`` in ``hour``, by the start of their
    trip or (``clock="snapshot"``, ``fact`` is ``train_movements``) by their snapshot.

    Both dimensions are filtered first and broadcast (bounded by the
    calendar), so the fact side is scanned once with no shuffle."""
    if clock == "snapshot":
        return cancelled_in_snapshot(fact, date, hour)
    if clock != "trip_start":
        raise ValueError(f"clock must be 'trip_start' or 'snapshot', got {clock!r}")
    d = dates.filter(F.col("date") == F.lit(date).cast("date")).select("date_id")
    t = times.filter(F.substring("time", 1, 2).cast("int") == F.lit(int(hour))).select("time_id")
    hits = (fact.filter(F.col("cancelled"))
            .join(F.broadcast(d), "date_id").join(F.broadcast(t), "time_id"))
    return hits.agg(F.count(F.lit(1)).alias("cancelled_movements"))


def avg_delay(fact: DataFrame, stations_dim: DataFrame, raw_name: str, prefix: str) -> DataFrame:
    """Q4: average of all arrival and departure delays at a loosely spelled
    station, in minutes (one row; NULL when there is none)."""
    sid = resolve_station(stations_dim, raw_name, prefix, "station_id").select("station_id")
    at = fact.join(F.broadcast(sid), "station_id")   # at most one row
    return delays_long(at).agg(F.avg("delay_minutes").alias("avg_delay_minutes"))


def avg_delay_from_rows(planned: DataFrame, changes: DataFrame, stations_dim: DataFrame, raw_name: str, prefix: str) -> DataFrame:
    """Q4 straight from planned and change rows, without a stored fact: the first
    planned row of each stop is kept, of these the station's, and only their changes
    are folded; no other dimension is built."""
    from railflow.operators.merge import first_wins
    from railflow.operators.names import lookup_table, resolve_names
    from railflow.operators.star import apply_changes
    first = first_wins(planned, ["stop_id"], ["snapshot_ts", "member"])
    rows = resolve_names(first, "station_name", lookup_table(stations_dim, "name", "station_id"), prefix, "station_id")
    sid = resolve_station(stations_dim, raw_name, prefix, "station_id").select("station_id")
    at = rows.join(F.broadcast(sid), "station_id")   # at most one row
    own = changes.join(at.select("stop_id"), "stop_id", "left_semi")
    return delays_long(apply_changes(at, own)).agg(F.avg("delay_minutes").alias("avg_delay_minutes"))


PEAK_HOURS = ((7, 9), (17, 19))   # fixed values: [07:00, 09:00) and [17:00, 19:00)


def peak_departures(movements: DataFrame, dates: tuple[str, str] | None = None) -> DataFrame:
    """Q6: per station, departures in the peak hours per day, averaged over
    all days in the table, or of those in ``dates`` (days without departures count as 0).

    The station x day grid is never built: the average over the grid is
    the station's peak-departure total divided by the number of days, so
    one aggregation per station plus one distinct-day count suffice."""
    movements = between_dates(movements, dates)
    h = F.hour("planned_departure_time")
    in_peak = F.lit(False)
    for lo, hi in PEAK_HOURS:
        in_peak = in_peak | ((h >= lo) & (h < hi))
    counted = (F.col("planned_departure_time").isNotNull() & F.col("snapshot_date").isNotNull() & in_peak)
    per_station = movements.groupBy("station_name").agg(F.count_if(counted).alias("_n"))
    days = movements.select(
        F.count_distinct("snapshot_date")
        + F.max(F.when(F.col("snapshot_date").isNull(), 1).otherwise(0))).scalar()
    # a NULL station never matches a grid cell, so it averages to 0
    total = F.when(F.col("station_name").isNotNull(), F.col("_n")).otherwise(F.lit(0))
    return (per_station.select("station_name", (total / days).alias("avg_num_train_departures_during_peak"))
            .orderBy("station_name"))
