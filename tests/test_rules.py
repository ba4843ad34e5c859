"""
adopted), plus the skew-splitting paths forced on small inputs."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from railflow.functions import minutes_between, parse_stamp, split_stop_id, trip_start
from railflow.operators import graph as G
from railflow.operators.fold import fold_changes
from railflow.operators.merge import first_wins, unmatched_changes
from railflow.operators.star import dim_train
from railflow.sources.analogs import documents_from_elements
from railflow.sources.timetables import change_rows, parse_changes


def test_stop_id_sign_kept_and_split(spark):
    # D3: the leading '-' stays part of the id; only parsing strips it
    df = spark.createDataFrame([("-111-2509020700-12",), ("222-2509020715-3",), ("junk",)], "stop_id string")
    rows = df.select("stop_id", *split_stop_id("stop_id"), trip_start("stop_id").alias("t")).collect()
    assert (rows[0].trip_key, rows[0].stop_index, rows[0].t) == ("-111-2509020700", 12, datetime(2025, 9, 2, 7, 0))
    assert (rows[1].trip_key, rows[1].stop_index) == ("222-2509020715", 3)
    assert (rows[2].trip_key, rows[2].stop_index, rows[2].t) == (None, None, None)


def test_two_digit_year_is_2000s(spark):
    # D20: Spark's rule, 70 -> 2070; bad text -> NULL instead of a failed job
    r = spark.range(1).select(parse_stamp(F.lit("7001010000")).alias("a"), parse_stamp(F.lit("99x")).alias("b")).first()
    assert r.a == datetime(2070, 1, 1) and r.b is None


def test_minutes_truncate_toward_zero(spark):
    # -90 s -> -1, +90 s -> 1
    r = spark.range(1).select(
        minutes_between(F.lit("2025-01-01 00:01:30").cast("timestamp_ntz"),
                        F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")).alias("neg"),
        minutes_between(F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"),
                        F.lit("2025-01-01 00:01:30").cast("timestamp_ntz")).alias("pos"),
        minutes_between(F.lit(None).cast("timestamp_ntz"), F.lit("2025-01-01").cast("timestamp_ntz")).alias("nul"),
    ).first()
    assert (r.neg, r.pos, r.nul) == (-1, 1, None)


def test_minutes_do_not_depend_on_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        r = spark.range(1).select(minutes_between(
            F.lit("2025-10-26 01:30:00").cast("timestamp_ntz"),
            F.lit("2025-10-26 03:30:00").cast("timestamp_ntz")).alias("m")).first()
        assert r.m == 120          # wall clock across the DST change
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def _changes(spark, rows):
    df = spark.createDataFrame(rows, "stop_id string, snapshot_ts timestamp_ntz, member string, "
                               "changed_arrival_time timestamp_ntz, changed_departure_time timestamp_ntz, "
                               "cancelled boolean, changed_platform string")
    return df


def test_last_policy_ignores_trailing_null_and_max_is_text_order(spark):
    # D5: 'last' keeps the last non-NULL value; 'max' compares platform text
    t = lambda m: datetime(2025, 9, 2, 7, m)
    ch = _changes(spark, [("s", t(0), "a", t(10), None, False, "9"),
                          ("s", t(15), "a", t(5), None, True, "10"),
                          ("s", t(30), "a", None, None, False, None)])
    last = fold_changes(ch, "last").first()
    mx = fold_changes(ch, "max").first()
    assert (last.changed_arrival_time, last.changed_platform, last.cancelled) == (t(5), "10", True)
    assert (mx.changed_arrival_time, mx.changed_platform, mx.cancelled) == (t(10), "9", True)


def test_unmatched_keeps_cancel_only_changes(spark):
    # D7: a change without a time for an unknown stop is still quarantined
    el = spark.createDataFrame(
        [(datetime(2025, 9, 2, 7, 0), "m", "X", 9, ("777-1-1", None, (None, None, "c", None)))],
        "snapshot_ts timestamp_ntz, member string, station string, eva_raw int, "
        "s struct<_id:string, ar:struct<_ct:string,_cp:string,_cs:string,_clt:string>, "
        "dp:struct<_ct:string,_cp:string,_cs:string,_clt:string>>")
    ch = change_rows(el)
    planned = spark.createDataFrame([("1-1-1",)], "stop_id string")
    rows = unmatched_changes(ch, planned).collect()
    assert len(rows) == 1 and rows[0].cancelled is True and rows[0].has_time is False


def test_train_dimension_nulls_equal(spark):
    # D22: labels differing only in which fields are NULL are one train each
    rows = [("N", "p", "800", "S", "5", None, "X"), ("N", "p", "800", "S", "5", None, "X"),
            ("N", "p", "800", "S", "5", "A", "X")]
    df = spark.createDataFrame(rows, "filter_flags string, trip_type string, owner string, trip_category string, "
                                     "train_number string, origin_station string, destination_station string")
    got = dim_train(df).orderBy("train_id").collect()
    assert [(r.train_id, r.origin_station) for r in got] == [(1, None), (2, "A")]


def test_first_writer_wins_against_existing(spark):
    # K7: first per key in order; keys already stored are not inserted again
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 5, "x")], "k string, o int, v string")
    existing = spark.createDataFrame([("b",)], "k string")
    got = first_wins(df, ["k"], ["o"], existing).collect()
    assert [(r.k, r.o, r.v) for r in got] == [("a", 1, "early")]


def test_arrival_before_departure_dropped(spark):
    # D18: a hop arriving before it departs is not a connection
    mv = spark.createDataFrame(
        [("t-1", "A", None, datetime(2025, 1, 1, 10)), ("t-2", "B", datetime(2025, 1, 1, 9), None)],
        "stop_id string, station_name string, planned_arrival_time timestamp_ntz, planned_departure_time timestamp_ntz")
    assert G.timed_connections(mv).count() == 0


def test_missing_source_gives_empty(spark):
    # D16: unknown source or target -> empty result, not an error
    e = spark.createDataFrame([("A", "B")], "src string, dst string")
    assert G.shortest_paths(e, "Z").count() == 0
    assert G.shortest_paths(e, "A", "Z").count() == 0


@pytest.mark.parametrize("blocks", [1, 3, 40])
def test_block_split_pairs_equal_unsplit(rail, blocks):
    # hot-trip splitting: any number of blocks gives the same edges/connections
    base = sorted(G.trip_edges(rail.movements_max).collect())
    assert sorted(G.trip_edges(rail.movements_max, blocks).collect()) == base
    cb = sorted(G.timed_connections(rail.movements_max).collect())
    assert sorted(G.timed_connections(rail.movements_max, blocks).collect()) == cb


def test_hot_trip_with_sparse_indexes_is_spread(spark):
    # one trip holds nearly all stops, with indexes far apart: blocks cut it by position
    from railflow.operators.index import sorted_blocks
    stops = spark.range(20000).select(F.concat(F.lit("9-2509020700-"), F.col("id") * 1_000_003).alias("stop_id"),
                                      (F.col("id") % 50).cast("string").alias("station_name"))
    cut = sorted_blocks(G._stops(stops), ["trip_key"], [F.col("stop_index").asc()], "b", 8)
    sizes = [r["count"] for r in cut.groupBy("b").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20000 / 8
    nxt = G.next_in_group(G._stops(stops), "trip_key", ["stop_index", "station_name"], ["stop_index"], 8)
    steps = nxt.select((F.col("next_stop_index") - F.col("stop_index")).alias("d")).groupBy("d").count().collect()
    assert sorted((r.d or 0, r["count"]) for r in steps) == [(0, 1), (1_000_003, 19999)]


def test_block_split_on_driver_tables(spark):
    from railflow.sources import analogs as A
    mv = A.hop_movements(spark, "/root/testdata/sf0.001")
    a = G.trip_edges(mv)
    b = G.trip_edges(mv, blocks=50)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_documents_split_into_bounded_pieces(spark, rail):
    # an XML document never holds more than about stops_per_document stops
    from railflow.sources import analogs as A
    ce = A.change_elements(spark, "/root/testdata/sf0.001")
    docs = documents_from_elements(ce, "change", pieces=10)
    sizes = docs.select(F.size(F.split("xml", "<s ")).alias("n")).agg(F.max("n")).first()[0] - 1
    assert sizes <= 40
    back = parse_changes(docs, "star")
    assert back.count() == ce.count()


def test_earliest_arrival_monotone_in_departure(rail):
    # property: leaving later never arrives earlier
    conns = G.timed_connections(rail.movements_max)
    a = {r.station_name: r.earliest_arrival for r in G.earliest_arrivals(conns, "Berlin Alexanderplatz",
                                                                          "2025-09-02 07:00:00").collect()}
    b = {r.station_name: r.earliest_arrival for r in G.earliest_arrivals(conns, "Berlin Alexanderplatz",
                                                                          "2025-09-02 08:00:00").collect()}
    for k, v in b.items():
        assert k in a and a[k] <= v


def test_bfs_deep_chain_compacts_levels(spark):
    # more than 16 levels: the visited union is compacted into a checkpoint
    e = spark.range(40).select(F.col("id").cast("string").alias("src"),
                               (F.col("id") + 1).cast("string").alias("dst"))
    row = G.shortest_paths(e, "0", "40").first()
    assert row.hops == 40 and row.path[0] == "0" and row.path[-1] == "40" and len(row.path) == 41
    assert G.shortest_paths(e, "0").count() == 41


def test_duplicate_stops_do_not_change_pairs(rail):
    # exact duplicate stops only form self-pairs, so no dedupe shuffle is needed
    mv = rail.movements_max
    dup = mv.unionByName(mv)
    assert sorted(G.trip_edges(dup).collect()) == sorted(G.trip_edges(mv).collect())
    assert sorted(G.timed_connections(dup).collect()) == sorted(G.timed_connections(mv).collect())


def test_bucketed_search_tables_give_same_answers(spark, rail):
    # opt-in: edge side written partitioned by station bucket, rounds read only touched buckets
    from railflow.sources import analogs as A
    edges = G.trip_edges(A.hop_movements(spark, "/root/testdata/sf0.001"))
    rows = lambda df: sorted((r.station_name, r.hops, tuple(r.path)) for r in df.collect())
    assert rows(G.shortest_paths(edges, "0")) == rows(G.shortest_paths(edges, "0", buckets=8))
    conns = G.timed_connections(rail.movements_max)
    ea = lambda df: sorted((r.station_name, r.earliest_arrival, r.prev) for r in df.collect())
    assert ea(G.earliest_arrivals(conns, "Berlin Alexanderplatz", "2025-09-02 07:00:00")) == \
        ea(G.earliest_arrivals(conns, "Berlin Alexanderplatz", "2025-09-02 07:00:00", buckets=4))


def test_bucketed_edges_are_partition_pruned(spark):
    e = spark.createDataFrame([(str(i), str(i + 1)) for i in range(50)], "src string, dst string")
    table = G._prepare(e, buckets=8)
    frontier = spark.createDataFrame([("3",)], "station_name string")
    probe = G._probe(frontier, 8)
    part = G._touched(table, probe, 8)
    j = F.broadcast(probe).join(part, G._on_station(F.col("station_name"), F.col("src"), 8))
    plan = j._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan" in line][0]
    import re
    # one bucket folder of eight is read: `_b = k` (or `_b IN (...)` for several)
    assert re.search(r"PartitionFilters: \[isnotnull\(_b#\d+\), \(?_b#\d+ (=|IN)", scan), scan
    assert [r.dst for r in j.collect()] == ["4"]


def test_rides_per_round_follow_the_out_degree(spark):
    # an edge with 20,000 departures: who reaches its station meets a few rows of it
    minute = F.make_dt_interval(F.lit(0), F.lit(0), F.col("id"))
    conns = spark.range(20000).select(
        F.lit("A").alias("src"), F.concat(F.lit("B"), F.col("id") % 2).alias("dst"),
        (F.lit("2025-01-01 00:00:00").cast("timestamp_ntz") + minute).alias("dp_time"),
        (F.lit("2025-01-01 00:30:00").cast("timestamp_ntz") + minute).alias("ar_time"), F.col("id").cast("string").alias("trip_key"))
    index, clock = G.departure_index(conns)
    assert index.count() <= 20000 * (1 + 1 / G.CELL_ROWS) + 2
    frontier = spark.range(40).select(F.lit("A").alias("source"), F.col("id").cast("string").alias("departure"), F.lit("A").alias("station_name"), (
        F.lit("2024-12-31 23:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id") * 371)).alias("earliest_arrival"))
    rides = G.rides_from(frontier, index, clock)
    assert rides.count() <= 40 * 2 * (G.CELL_ROWS + 2)
    best = rides.groupBy("departure", "station_name").agg(F.min("a").alias("a"))
    want = frontier.join(conns, F.col("dp_time") >= F.col("earliest_arrival")).groupBy("departure", F.col("dst").alias("station_name")).agg(
        F.min("ar_time").alias("a"))
    assert sorted(best.collect()) == sorted(want.collect())


def test_index_agrees_with_every_later_connection(spark):
    # random connections with ties, one busy edge, long pauses; and cells in many ranges
    import random
    rng = random.Random(11)
    rows = [(rng.choice("ABC"), rng.choice("DEF"), rng.choice([rng.randrange(100), rng.randrange(100000), 5]), rng.randrange(60), str(i % 7))
            for i in range(3000)] + [("A", "D", 3 * i, 50, "x") for i in range(3000)]
    at = lambda c: F.lit("2025-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col(c).cast("decimal(18,6)"))
    conns = spark.createDataFrame(rows, "src string, dst string, s int, d int, trip_key string").select(
        "src", "dst", at("s").alias("dp_time"), (at("s") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("d").cast("decimal(18,6)"))).alias("ar_time"), "trip_key")
    frontier = spark.createDataFrame([(u, str(k), u, rng.choice([rng.randrange(120), rng.randrange(110000)])) for u in "ABCZ" for k in range(60)],
                                     "source string, departure string, station_name string, s int").withColumn("earliest_arrival", at("s")).drop("s")
    key = ["source", "departure", "station_name"]
    coarse = G.COARSE
    try:
        for G.COARSE in (3, coarse):
            index, clock = G.departure_index(conns)
            got = G.rides_from(frontier, index, clock).groupBy(*key).agg(F.min(F.struct("a", "d", "u", "t")).alias("m"))
            want = frontier.join(conns, (F.col("station_name") == F.col("src")) & (F.col("dp_time") >= F.col("earliest_arrival"))).select(
                "source", "departure", F.col("dst").alias("station_name"), F.struct(F.col("ar_time").alias("a"), F.col("dp_time").alias("d"),
                F.col("src").alias("u"), F.col("trip_key").alias("t")).alias("m")).groupBy(*key).agg(F.min("m").alias("m"))
            assert sorted(got.collect()) == sorted(want.collect())
    finally:
        G.COARSE = coarse


def test_search_from_both_ends_equals_full_search(spark):
    import random
    rng = random.Random(5)
    rows = {(str(rng.randrange(60)), str(rng.randrange(60))) for _ in range(150)} | {(f"c{i}", f"c{i + 1}") for i in range(14)}
    e = spark.createDataFrame(sorted(rows), "src string, dst string")
    nodes = sorted({x for r in rows for x in r})
    pairs = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(60)] + [("c0", "c14"), ("c3", "c3"), ("c14", "c0")]
    full = {(r.source, r.station_name): (r.hops, r.path) for r in G.shortest_paths_batch(
        e, spark.createDataFrame([(s,) for s, _ in set(pairs)], "source string").distinct()).collect()}
    for buckets in (None, 4):
        got = {(r.source, r.station_name): (r.hops, r.path) for r in G.shortest_paths_batch(
            e, spark.createDataFrame(pairs, "source string, target string"), buckets).collect()}
        assert got == {p: full[p] for p in pairs if p in full}


def test_edge_lists_page_the_one_list_per_edge(rail):
    conns = G.timed_connections(rail.movements_max)
    pages = G.edge_lists(conns, 2).collect()
    assert all(r.n_connections == len(r.connections) <= 2 for r in pages)
    lists = {}
    for r in sorted(pages, key=lambda r: (r.src, r.dst, r.page)):
        assert r.page == len(lists.setdefault((r.src, r.dst), [])) / 2
        lists[r.src, r.dst] += [tuple(c) for c in r.connections]
    want = {}
    for r in conns.collect():
        want.setdefault((r.src, r.dst), []).append((r.dp_time, r.ar_time, r.trip_key))
    assert lists == {k: sorted(v) for k, v in want.items()}


def test_nearest_is_exact_and_not_hurt_by_an_outlier(spark):
    import random

    from railflow.operators.nearest import nearest_stations, station_tree
    rng = random.Random(2)
    near = [(f"s{i}", rng.gauss(52, 0.1), rng.gauss(13, 0.2)) for i in range(1500)] + [(f"t{i}", 52.0, 13.0) for i in range(300)]
    points = [(i, rng.gauss(52, 0.2), rng.gauss(13, 0.4)) for i in range(300)] + [(300, 0.0, 0.0), (301, 52.0, 13.0), (302, None, 1.0), (303, 9e9, 9e9)]
    for extra in ([], [("far", 1e7, -1e7)]):
        st = spark.createDataFrame(near + extra, "name string, latitude double, longitude double")
        _, boxes = station_tree(st)
        assert boxes[-1].count() > 60              # the cells of the others stay small
        got = {r.point_id: (r.name, r.distance) for r in nearest_stations(spark.createDataFrame(points, "point_id int, latitude double, longitude double"), st).collect()}
        for i, y, x in points:
            want = min(((((y - a) ** 2 + (x - b) ** 2) ** 0.5, n) for n, a, b in near + extra), default=None) if y is not None else (None, None)
            assert got[i] == (want[1], pytest.approx(want[0]))


def test_date_bounds_reach_the_stored_folders(spark, rail, tmp_path):
    from railflow.plans import queries as Q
    from railflow.plans.incremental import load_movements
    from railflow.plans.pipelines import resolve_planned
    mv = load_movements(resolve_planned(rail.planned, rail.stations), rail.changes_parquet, f"{tmp_path}/m")
    day = str(mv.select(F.min("snapshot_date")).first()[0])
    whole = Q.daily_avg_delay(mv, "Berlin Ostkreuz").collect()
    one = Q.daily_avg_delay(mv, "Berlin Ostkreuz", dates=(day, day))
    assert one.collect() == [r for r in whole if str(r.snapshot_date) == day]
    loose = Q.daily_avg_delay(mv, "Ostkreuz", resolve=True, stations=rail.stations, prefix="Berlin")
    assert [r.avg_delay_minutes for r in loose.collect()] == [r.avg_delay_minutes for r in whole]
    peak = Q.peak_departures(mv, dates=(day, day))
    assert Q.cancelled_at(mv, None, None, day, 7, clock="snapshot").first()[0] == mv.where(
        (F.col("snapshot_date") == day) & (F.col("snapshot_hour") == 7) & F.col("cancelled")).count()
    for df in (one, peak, Q.cancelled_in_snapshot(mv, day, 7)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_avg_delay_from_rows_equals_the_fact(rail):
    from railflow.plans import queries as Q
    for name in ("Ostkreuz", "Berlin-Wedding", "Nowhere"):
        a = Q.avg_delay(rail.star["fact_train_movements"], rail.star["dim_station"], name, "Berlin").collect()
        b = Q.avg_delay_from_rows(rail.planned, rail.changes_star, rail.star["dim_station"], name, "Berlin").collect()
        assert a == b
