"""Worked answers of the hand fixture (FIXTURES.md §B)."""

from datetime import date, datetime

from pyspark.sql import functions as F

from railflow.operators import graph as G
from railflow.operators.fold import fold_changes
from railflow.operators.names import lookup_table, resolve_names
from railflow.operators.nearest import nearest_station, nearest_stations
from railflow.plans import queries as Q
from railflow.sources.timetables import malformed_documents
from tests.handfixture import A, O, S, W

TWO = "-111-2509020700-2"


def _one(df, **where):
    for k, v in where.items():
        df = df.filter(F.col(k) == v)
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_station_json_has_47_columns(rail):
    assert len(rail.stations.columns) == 47
    row = _one(rail.stations, name=A)
    assert row.eva_number == 1 and float(row.longitude) == 13.41 and float(row.latitude) == 52.52
    assert row.hasMobilityService is False          # "no"
    assert _one(rail.stations, name=O).hasMobilityService is True


def test_archive_members_and_snapshots(rail):
    assert rail.planned_docs.count() == 10           # 8 documents + empty + malformed
    assert rail.planned_docs.filter(F.col("snapshot_ts").isNull()).count() == 0
    snap = _one(rail.change_docs, member="2509030845/Berlin Alexanderplatz/changes.xml").snapshot_ts
    assert snap == datetime(2025, 9, 3, 8, 45)


def test_empty_and_malformed_documents(rail):
    assert rail.planned.count() == 9                  # empty <timetable/> gives no rows
    bad = malformed_documents(rail.planned_docs).collect()
    assert [r.member for r in bad] == ["2509020800/Berlin-Wedding/broken.xml"]


def test_planned_platform_departure_replaces_arrival(rail):
    assert _one(rail.planned, stop_id=TWO).planned_platform == "3"


def test_path_ends(rail):
    row = _one(rail.planned, stop_id=TWO)
    assert row.origin_station == "Origin 111" and row.destination_station == "Terminus 111"


def test_changed_platform_rules(rail):
    at = datetime(2025, 9, 2, 7, 15)
    assert _one(rail.changes_parquet, stop_id=TWO, snapshot_ts=at).changed_platform is None
    assert _one(rail.changes_star, stop_id=TWO, snapshot_ts=at).changed_platform == "5"


def test_fold_max(rail):
    row = _one(rail.movements_max, stop_id=TWO)
    assert row.changed_arrival_time == datetime(2025, 9, 2, 7, 12)
    assert row.changed_departure_time == datetime(2025, 9, 2, 7, 13)
    assert (row.arrival_delay_minutes, row.departure_delay_minutes) == (4, 4)
    assert row.changed_platform == "10"               # parquet rule
    star_max = _one(fold_changes(rail.changes_star, "max"), stop_id=TWO)
    assert star_max.changed_platform == "5"           # text order: '5' > '10'


def test_fold_last(rail):
    row = _one(rail.movements_last, stop_id=TWO)
    assert row.changed_arrival_time == datetime(2025, 9, 2, 7, 10)
    assert row.changed_departure_time == datetime(2025, 9, 2, 7, 11)
    assert (row.arrival_delay_minutes, row.departure_delay_minutes) == (2, 2)
    assert row.changed_platform == "10"


def test_cancellation_is_sticky(rail):
    assert _one(rail.movements_last, stop_id="222-2509020715-1").cancelled is True
    assert _one(rail.star["fact_train_movements"], stop_id="222-2509020715-1").cancelled is True


def test_unmatched(rail):
    rows = rail.star["unmatched_timetable_changes"].collect()
    assert [r.stop_id for r in rows] == ["999-2509020800-1"]
    assert rows[0].eva_number == 99 and rows[0].has_time is True


def test_resolve_names(rail, spark):
    raw = spark.createDataFrame([("Alexanderplatz",), ("Wedding",), ("Berlin Potsdam Hbf",), ("Hamburg",)], "n string")
    got = {r.n: r.resolved_id for r in resolve_names(raw, "n", lookup_table(rail.stations)).collect()}
    assert got == {"Alexanderplatz": 1, "Wedding": 3, "Berlin Potsdam Hbf": 5, "Hamburg": None}


def test_resolved_eva_on_movements(rail):
    assert _one(rail.movements_max, stop_id=TWO).eva_number == 2


def test_station_by_name(rail):
    row = _one(Q.station_by_name(rail.stations, "Alexanderplatz", "Berlin"))
    assert (row.name, row.identifier) == (A, 1)
    assert Q.station_by_name(rail.stations, "Hamburg", "Berlin").count() == 0


def test_nearest(rail, spark):
    assert _one(nearest_station(rail.stations, 52.5, 13.4)).name == A
    pts = spark.createDataFrame([(1, 52.5, 13.4), (2, 52.4, 13.0)], "point_id long, latitude double, longitude double")
    got = {r.point_id: r.name for r in nearest_stations(pts, rail.stations).collect()}
    assert got == {1: A, 2: "Potsdam Hbf"}
    grid = {r.point_id: r.name for r in nearest_stations(pts, rail.stations, leaf=1).collect()}
    assert grid == got


def test_cancelled_at(rail):
    st = rail.star
    assert _one(Q.cancelled_at(st["fact_train_movements"], st["dim_date"], st["dim_time"], "2025-09-02", 7)).cancelled_movements == 1
    assert _one(Q.cancelled_at(st["fact_train_movements"], st["dim_date"], st["dim_time"], "2025-09-02", 17)).cancelled_movements == 0


def test_avg_delay(rail):
    st = rail.star
    assert _one(Q.avg_delay(st["fact_train_movements"], st["dim_station"], "Ostkreuz", "Berlin")).avg_delay_minutes == 2.0
    # the same stop under the max policy
    assert _one(rail.movements_max.filter(F.col("station_name") == O)
                .select(F.avg(F.col("arrival_delay_minutes")).alias("a"))).a == 4.0


def test_daily_avg_delay(rail):
    rows = Q.daily_avg_delay(rail.movements_max, A).collect()
    assert [(r.snapshot_date, r.avg_delay_minutes) for r in rows] == [(date(2025, 9, 3), -2.0)]


def test_peak_departures(rail):
    got = {r.station_name: r.avg_num_train_departures_during_peak for r in Q.peak_departures(rail.movements_max).collect()}
    assert got == {A: 0.5, O: 1.0, W: 0.5, S: 0.0}


def test_peak_departures_is_ordered(rail):
    names = [r.station_name for r in Q.peak_departures(rail.movements_max).collect()]
    assert names == sorted(names)


def test_edges(rail):
    got = {(r.src, r.dst) for r in G.trip_edges(rail.movements_max).collect()}
    assert got == {(A, O), (O, W), (O, S), (W, S), (A, W)}


def test_shortest_path(rail):
    edges = G.trip_edges(rail.movements_max)
    row = _one(G.shortest_paths(edges, A, S))
    assert row.path == [A, O, S] and row.hops == 2
    assert G.shortest_paths(edges, S, A).count() == 0
    assert _one(G.shortest_paths(edges, A, A)).hops == 0


def test_earliest_arrival(rail):
    conns = G.timed_connections(rail.movements_max)
    row = _one(G.earliest_arrival(conns, A, S, datetime(2025, 9, 2, 7, 0)))
    assert row.earliest_arrival == datetime(2025, 9, 2, 7, 40) and row.path == [A, O, S]
    assert G.earliest_arrival(conns, A, S, datetime(2025, 9, 2, 7, 1)).count() == 0
    row = _one(G.earliest_arrival(conns, A, W, "2025-09-02 07:00:00"))
    assert row.earliest_arrival == datetime(2025, 9, 2, 7, 20) and row.path == [A, O, W]


def test_daily_order(rail):
    rows = Q.daily_avg_delay(rail.movements_max, W).collect()
    assert [r.snapshot_date for r in rows] == sorted(r.snapshot_date for r in rows)


def test_daily_avg_delay_sql_form(rail):
    a = Q.daily_avg_delay(rail.movements_max, A).collect()
    b = Q.daily_avg_delay_sql(rail.movements_max, A).collect()
    assert a == b
    # a quote in the name is data, not SQL
    assert Q.daily_avg_delay_sql(rail.movements_max, "x' OR '1'='1").count() == 0


def test_archive_name_carried(rail):
    assert {r.archive.rsplit("/", 1)[-1] for r in rail.planned.select("archive").distinct().collect()} == \
        {"250902_250909.tar.gz"}


def test_nearest_grid_matches_broadcast_on_driver_tables(spark):
    from railflow.sources import analogs as A_
    pts = A_.query_points(spark, "/root/testdata/sf0.001")
    st = A_.station_points(spark, "/root/testdata/sf0.001")
    a = nearest_stations(pts, st).select("point_id", "name")
    b = nearest_stations(pts, st, leaf=1).select("point_id", "name")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_batch_bfs_equals_single_runs(rail, spark):
    edges = G.trip_edges(rail.movements_max)
    req = spark.createDataFrame([(A, None), (O, S), (W, A), ("Nowhere", None)], "source string, target string")
    got = {(r.source, r.station_name): (r.hops, r.path) for r in G.shortest_paths_batch(edges, req).collect()}
    want = {(A, r.station_name): (r.hops, r.path) for r in G.shortest_paths(edges, A).collect()}
    want.update({(O, r.station_name): (r.hops, r.path) for r in G.shortest_paths(edges, O, S).collect()})
    assert got == want                     # W -> A unreachable, unknown source: nothing


def test_batch_earliest_arrival_equals_single_runs(rail, spark):
    conns = G.timed_connections(rail.movements_max)
    deps = ["2025-09-02 07:00:00", "2025-09-02 07:01:00", "2025-09-02 17:00:00"]
    req = spark.createDataFrame([(A, d) for d in deps] + [(O, deps[0])], "source string, departure string")
    best = G.earliest_arrivals_batch(conns, req)
    for src, dep in [(A, d) for d in deps] + [(O, deps[0])]:
        one = {r.station_name: r.earliest_arrival for r in G.earliest_arrivals(conns, src, dep).collect()}
        many = {r.station_name: r.earliest_arrival for r in
                best.filter((F.col("source") == src) & (F.col("departure") == F.lit(dep).cast("timestamp_ntz"))).collect()}
        assert one == many
    targets = spark.createDataFrame([(A, deps[0], S), (A, deps[0], W), (A, deps[1], S)],
                                    "source string, departure string, target string").select(
        "source", F.col("departure").cast("timestamp_ntz").alias("departure"), "target")
    paths = {(r.target): (r.earliest_arrival, r.path) for r in
             G.arrival_paths(best, targets).filter(F.col("departure") == F.lit(deps[0]).cast("timestamp_ntz")).collect()}
    assert paths == {S: (datetime(2025, 9, 2, 7, 40), [A, O, S]), W: (datetime(2025, 9, 2, 7, 20), [A, O, W])}
