"""Registered queries over the driver tables: ``name -> fn(spark, sf_dir)``.

Each entry wires analog inputs (``sources.analogs``) into the library
operators with the fixed parameters documented next to it; the matching
DuckDB oracle is in ``plans.oracle``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railflow.functions import (
    changed_platform, minutes_between, snapshot_from_member, split_stop_id, trip_start,
)
from railflow.operators import graph as G
from railflow.operators import star as S
from railflow.operators.fold import fold_changes
from railflow.operators.merge import first_wins, unmatched_changes as unmatched
from railflow.operators.names import lookup_table, resolve_names
from railflow.operators.nearest import nearest_station as nearest_one, nearest_stations
from railflow.plans import queries as Q
from railflow.plans.incremental import load_calendar, load_movements, load_star
from railflow.plans.pipelines import build_movements, resolve_planned
from railflow.session import ensure_checkpoint_dir
from railflow.schemas import MOVEMENT_COLUMNS
from railflow.sources import analogs as A
from railflow.sources.timetables import change_rows, parse_changes, parse_planned, planned_rows

PREFIX = A.STATION_PREFIX
# Fixed parameters of the registered runs.
STATION = "NATION 7"              # a raw (document) spelling, exact match in Q5
LOOKUP_NAME = "NATION 5"          # Q1: resolves by stripping the prefix
DELAY_NAME = "7"                  # Q4: resolves by adding "NATION "
CANCEL_DATE, CANCEL_HOUR = "2024-01-15", 15
POINT = (0.0, 0.0)                # Q2 position (latitude, longitude)
LOAD_DAY = "2028-06-15"          # both incremental loads hold this day
HOP_SOURCE = "0"                  # part key the hop search starts from
HOP_TARGET = "7"
TIMED_SOURCE, DEPARTURE = "0", "2024-01-01 00:00:00"
LIST_PAGE = 4


def movements(spark: SparkSession, d: str) -> DataFrame:
    return build_movements(A.planned_elements(spark, d), A.change_elements(spark, d),
                           A.stations(spark, d), prefix=PREFIX, policy="max",
                           platform_rule="parquet")


def snapshot_parse(spark, d):
    m = A.member_paths(spark, d)
    ts = snapshot_from_member("member")
    return m.select("event_id", "member", ts.alias("snapshot_ts")).select(
        "event_id", "member", "snapshot_ts",
        F.to_date("snapshot_ts").alias("snapshot_date"),
        F.hour("snapshot_ts").alias("snapshot_hour"),
        F.minute("snapshot_ts").alias("snapshot_minute"),
        F.col("snapshot_ts").isNull().alias("quarantined"))


def parse_stop_id(spark, d):
    return A.hop_movements(spark, d).select(
        "stop_id", *split_stop_id("stop_id"), trip_start("stop_id").alias("trip_start"))


def path_ends(spark, d):
    return planned_rows(A.planned_elements(spark, d)).select(
        "stop_id", "origin_station", "destination_station")


def platform_rule(spark, d):
    planned = planned_rows(A.planned_elements(spark, d)).select(
        F.lit("planned").alias("rule"), "stop_id", F.lit("").alias("member"),
        F.col("planned_platform").alias("platform"))
    ch = A.change_elements(spark, d)
    ar, dp = F.col("s.ar"), F.col("s.dp")
    # both rules from one scan of the change elements
    both = ch.select(F.col("s._id").alias("stop_id"), "member", F.stack(
        F.lit(2), F.lit("parquet"), changed_platform(ar, dp, "parquet"),
        F.lit("star"), changed_platform(ar, dp, "star")).alias("rule", "platform"))
    return planned.unionByName(both.select("rule", "stop_id", "member", "platform"))


def delay_minutes(spark, d):
    li = A.table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("last_ship"), F.min("l_shipdate").alias("first_ship"))
    o = A.table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    j = o.join(li, o.o_orderkey == li.l_orderkey)
    return j.select("o_orderkey",
                    minutes_between("o_orderdate", "last_ship").alias("arrival_delay_minutes"),
                    minutes_between("o_orderdate", "first_ship").alias("departure_delay_minutes"))


def fold_changes_max(spark, d):
    return fold_changes(change_rows(A.change_elements(spark, d), "parquet"), "max")


def fold_changes_last(spark, d):
    return fold_changes(change_rows(A.change_elements(spark, d), "star"), "last")


def merge_movements(spark, d):
    return movements(spark, d)


def daily_avg_delay(spark, d):
    return Q.daily_avg_delay(movements(spark, d), STATION)


def delay_unpivot(spark, d):
    return Q.delays_long(movements(spark, d), "stop_id")


def resolve_name(spark, d):
    c = A.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = A.table(spark, d, "nation").select("n_nationkey", "n_name")
    raw = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).select(
        "c_custkey", A.raw_station_name("n_name", "c_custkey").alias("raw_name"))
    lookup = lookup_table(A.stations(spark, d))
    return resolve_names(raw, "raw_name", lookup, PREFIX, "resolved_id").select(
        "c_custkey", "raw_name", "resolved_id")


PLANNED_COLUMNS = ["stop_id", "station_name", "eva_raw", "snapshot_ts", "filter_flags", "trip_type",
                   "owner", "trip_category", "train_number", "origin_station", "destination_station",
                   "planned_arrival_time", "planned_departure_time", "cancelled", "planned_platform"]
CHANGE_COLUMNS = ["stop_id", "station_name", "eva_raw", "snapshot_ts", "changed_arrival_time",
                  "changed_departure_time", "cancelled", "changed_platform", "has_time"]


def xml_planned(spark, d):
    docs = A.documents_from_elements(A.planned_elements(spark, d), "planned")
    return parse_planned(docs).select(*PLANNED_COLUMNS)


def xml_changes(spark, d):
    docs = A.documents_from_elements(A.change_elements(spark, d), "change")
    return parse_changes(docs, "star").select(*CHANGE_COLUMNS)


def _planned(spark, d):
    return planned_rows(A.planned_elements(spark, d))


def _trip_planned(spark, d):
    # the analog stop ids embed no trip start: the planned time stands in
    return _planned(spark, d).withColumn("trip_start", F.col("snapshot_ts"))


def dim_station(spark, d):
    return S.dim_station(A.stations(spark, d))


def dim_train(spark, d):
    return S.dim_train(_planned(spark, d))


def fact_first_wins(spark, d):
    li = A.table(spark, d, "lineitem")
    return first_wins(li, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_shipdate"])


def upsert_last(spark, d):
    first = first_wins(_planned(spark, d), ["stop_id"], ["snapshot_ts", "member"])
    out = S.apply_changes(first, change_rows(A.change_elements(spark, d), "star"))
    return out.select("stop_id", "planned_arrival_time", "planned_departure_time", "changed_arrival_time",
                      "changed_departure_time", "arrival_delay_minutes", "departure_delay_minutes",
                      "cancelled", "planned_platform", "changed_platform")


def unmatched_changes(spark, d):
    planned = planned_rows(A.matched_planned_elements(spark, d))
    return unmatched(change_rows(A.change_elements(spark, d), "star"), planned)


def star_tables(spark, d):
    """The star schema of the analog; every query builds its own."""
    planned = _trip_planned(spark, d)
    dims = {"dim_station": S.dim_station(A.stations(spark, d)), "dim_train": S.dim_train(planned),
            "dim_date": S.dim_date(planned), "dim_time": S.dim_time(planned)}
    fact = S.build_fact(planned, change_rows(A.change_elements(spark, d), "star"),
                        dims["dim_station"], dims["dim_train"], dims["dim_date"], dims["dim_time"],
                        trip_start_col=F.col("snapshot_ts"), prefix=PREFIX)
    return {**dims, "fact_train_movements": fact}


def star_fact_df(spark, d):
    return star_tables(spark, d)["fact_train_movements"]


def star_fact(spark, d):
    return star_fact_df(spark, d)


def station_by_name(spark, d):
    return Q.station_by_name(A.stations(spark, d), LOOKUP_NAME, PREFIX)


def avg_delay(spark, d):
    """Q4 from the rows of one station (``Q.avg_delay`` asks a stored fact)."""
    return Q.avg_delay_from_rows(_planned(spark, d), change_rows(A.change_elements(spark, d), "star"),
                                 S.dim_station(A.stations(spark, d)), DELAY_NAME, PREFIX)


def peak_departures(spark, d):
    return Q.peak_departures(A.event_trips(spark, d))


def dim_date(spark, d):
    return S.dim_date(A.event_trips(spark, d))


def dim_time(spark, d):
    return S.dim_time(A.event_trips(spark, d))


def cancelled_at(spark, d):
    dates, times = dim_date(spark, d), dim_time(spark, d)
    fact = S.with_date_time_keys(A.event_trips(spark, d), dates, times)
    return Q.cancelled_at(fact, dates, times, CANCEL_DATE, CANCEL_HOUR)


def nearest_station(spark, d):
    return nearest_one(A.station_points(spark, d), *POINT)


def nearest_station_batch(spark, d):
    return nearest_stations(A.query_points(spark, d), A.stations(spark, d)).select("point_id", "name")


def trip_edges(spark, d):
    return G.trip_edges(A.hop_movements(spark, d))


def timed_connections(spark, d):
    return G.timed_connections(A.timed_movements(spark, d))


def _fmt_ts(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def edge_connections(spark, d):
    nested = G.edge_connections(G.timed_connections(A.timed_movements(spark, d)))
    text = F.array_join(F.transform("connections", lambda x: F.concat_ws(
        "|", _fmt_ts(x["dp_time"]), _fmt_ts(x["ar_time"]), x["trip_key"])), ";")
    return nested.select("src", "dst", "period", "n_connections", text.alias("connections"))


def edge_lists(spark, d):
    """One list per edge, in pages of four."""
    pages = G.edge_lists(G.timed_connections(A.timed_movements(spark, d)), LIST_PAGE)
    text = F.array_join(F.transform("connections", lambda x: F.concat_ws(
        "|", _fmt_ts(x["dp_time"]), _fmt_ts(x["ar_time"]), x["trip_key"])), ";")
    return pages.select("src", "dst", "page", "n_connections", text.alias("connections"))


def shortest_path(spark, d):
    paths = G.shortest_paths(G.trip_edges(A.hop_movements(spark, d)), HOP_SOURCE)
    return paths.select("station_name", "hops", F.array_join("path", ">").alias("path"))


def earliest_arrival(spark, d):
    best = G.earliest_arrivals(G.timed_connections(A.timed_movements(spark, d)), TIMED_SOURCE, DEPARTURE)
    return best.select("station_name", "earliest_arrival")


def earliest_arrival_path(spark, d):
    """Q8 for every station at once: the arrival and the stations on the way."""
    conns = G.timed_connections(A.timed_movements(spark, d))
    req = spark.range(1).select(F.lit(TIMED_SOURCE).alias("source"), F.lit(DEPARTURE).cast("timestamp_ntz").alias("departure"))
    best = G.earliest_arrivals_batch(conns, req)
    paths = G.arrival_paths(best, best.select("source", "departure", F.col("station_name").alias("target")))
    return paths.select(F.col("target").alias("station_name"), "earliest_arrival", F.array_join("path", ">").alias("path"))


def earliest_arrival_all(spark, d):
    """Batch form: every station of the timed graph as a source, one loop."""
    conns = G.timed_connections(A.timed_movements(spark, d))
    req = conns.select(F.col("src").alias("source")).distinct().select(
        "source", F.lit(DEPARTURE).cast("timestamp_ntz").alias("departure"))
    return G.earliest_arrivals_batch(conns, req).select("source", "station_name", "earliest_arrival")


def _loads(df):
    """The rows of two loads that share one day (like weekly archives)."""
    day = F.to_date("snapshot_ts")
    return df.filter(day <= F.lit(LOAD_DAY).cast("date")), df.filter(day >= F.lit(LOAD_DAY).cast("date"))


def _load_folder(spark, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def incremental_movements(spark, d):
    """The merged fact after two loads: equal to one load of everything.  The planned
    rows of the day that both loads share come twice in each of them.
    (The analog has a snapshot per day and few rows in each: one folder per hour.)"""
    out = _load_folder(spark, "movements")
    planned = resolve_planned(_planned(spark, d), A.stations(spark, d), PREFIX)
    planned = planned.unionByName(planned.where(F.to_date("snapshot_ts") == F.lit(LOAD_DAY).cast("date")))
    for p, c in zip(_loads(planned), _loads(change_rows(A.change_elements(spark, d), "parquet"))):
        loaded = load_movements(p, c, out, layout=["snapshot_hour"])
    return loaded.select(*MOVEMENT_COLUMNS)


def incremental_star(spark, d):
    """The fact after two loads, with its dimensions' natural keys."""
    out = _load_folder(spark, "star")
    for p, c in zip(_loads(_planned(spark, d)), _loads(change_rows(A.change_elements(spark, d), "star"))):
        t = load_star(p, c, A.stations(spark, d), out, PREFIX, F.col("snapshot_ts"))
    fact = t["fact_train_movements"]
    for name, key in (("dim_train", "train_id"), ("dim_date", "date_id"), ("dim_time", "time_id")):
        fact = fact.join(t[name], key, "left").drop(key)
    return fact


def stable_dim_keys(spark, d):
    """Dates and times after two loads: the first load's keys stay."""
    out = _load_folder(spark, "calendar")
    for p in _loads(_planned(spark, d)):
        t = load_calendar(p, out, F.col("snapshot_ts"))
    return t["dim_date"].select(F.lit("date").alias("dim"), F.col("date_id").alias("id"),
                                F.col("date").cast("string").alias("member")).unionByName(
        t["dim_time"].select(F.lit("time").alias("dim"), F.col("time_id").alias("id"), F.col("time").alias("member")))


def shortest_path_target(spark, d):
    """One source to one target (Q7 as asked by a user)."""
    paths = G.shortest_paths(G.trip_edges(A.hop_movements(spark, d)), HOP_SOURCE, HOP_TARGET)
    return paths.select("station_name", "hops", F.array_join("path", ">").alias("path"))


QUERIES = {
    "incremental_movements": incremental_movements,
    "incremental_star": incremental_star,
    "stable_dim_keys": stable_dim_keys,
    "shortest_path_target": shortest_path_target,
    "snapshot_parse": snapshot_parse,
    "parse_stop_id": parse_stop_id,
    "path_ends": path_ends,
    "platform_rule": platform_rule,
    "delay_minutes": delay_minutes,
    "fold_changes_max": fold_changes_max,
    "fold_changes_last": fold_changes_last,
    "merge_movements": merge_movements,
    "daily_avg_delay": daily_avg_delay,
    "delay_unpivot": delay_unpivot,
    "resolve_name": resolve_name,
    "xml_planned": xml_planned,
    "xml_changes": xml_changes,
    "dim_station": dim_station,
    "dim_date": dim_date,
    "dim_time": dim_time,
    "dim_train": dim_train,
    "fact_first_wins": fact_first_wins,
    "upsert_last": upsert_last,
    "unmatched_changes": unmatched_changes,
    "star_fact": star_fact,
    "station_by_name": station_by_name,
    "avg_delay": avg_delay,
    "peak_departures": peak_departures,
    "cancelled_at": cancelled_at,
    "nearest_station": nearest_station,
    "nearest_station_batch": nearest_station_batch,
    "trip_edges": trip_edges,
    "timed_connections": timed_connections,
    "edge_connections": edge_connections,
    "edge_lists": edge_lists,
    "shortest_path": shortest_path,
    "earliest_arrival": earliest_arrival,
    "earliest_arrival_path": earliest_arrival_path,
    "earliest_arrival_all": earliest_arrival_all,
}
