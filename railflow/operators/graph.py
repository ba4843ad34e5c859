"""Station graphs and the two searches.

Graphs are edge DataFrames.  Consecutive stops of a trip are paired by
``next_in_group``: a ``lead`` over windows of one trip *and one block of
neighbouring stops*, so a trip with very many stops is spread over many tasks;
the pairs that cross a block boundary are stitched from the first row of
each block.

Both searches are batch frontier loops keyed by (request, station), so one
round serves every request: frontier -> join edges/index -> min per
(request, station) -> improvement test.  A round writes only what it adds, to a
folder of its own in the session's reliable checkpoint folder (``_Levels``): the
lineage stays one round long, a lost executor only re-runs one round, and no state
is ever rewritten.  Hop searches carry a predecessor and a rank per station, timed
ones meet a suffix-minimum index of departures (``departure_index``).  The edge side
is checkpointed once with balanced (round-robin) partitions, so a station with a huge
out-degree is spread over all tasks; with ``buckets=N`` it is instead
written partitioned by station bucket and each round reads only the
bucket folders its frontier touches.  How a
round's join runs is left to AQE, which broadcasts a side by its measured
bytes and else shuffles (and splits skewed partitions).
"""

from __future__ import annotations

import functools
import logging
import time
import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from railflow.functions.stopid import stop_index, trip_key
from railflow.operators.index import sorted_blocks, with_position
from railflow.operators.merge import first_wins
from railflow.operators.sinks import PARTITION_COLUMNS, remove
from railflow.session import ensure_checkpoint_dir

log = logging.getLogger(__name__)


def _stops(movements: DataFrame, *extra: str) -> DataFrame:
    """Parsed stops, one per ``(trip_key, stop_index)``: a stop that was
    planned again in a later snapshot, or two stations on one index, count as
    first seen (by snapshot if the movements carry it, then by the other columns)."""
    m = movements.dropna(subset=["stop_id", "station_name"])
    seen = [c for c in PARTITION_COLUMNS if c in movements.columns]
    parsed = m.select(trip_key("stop_id").alias("trip_key"), stop_index("stop_id").alias("stop_index"),
                      *seen, "station_name", *extra)
    parsed = parsed.filter(F.col("trip_key").isNotNull() & F.col("stop_index").isNotNull())
    first = first_wins(parsed, ["trip_key", "stop_index"], [*seen, "station_name", *extra])
    return first.select("trip_key", "stop_index", "station_name", *extra)


def next_in_group(df: DataFrame, group: str, order: list[str], carry: list[str], blocks: int | None = None) -> DataFrame:
    """``df`` plus ``next_<c>`` for every ``c`` in ``carry``: the values of
    the following row of the same ``group`` in ``order`` (NULL for the last
    row).  The order must be total.

    Windows run over blocks of neighbouring rows (``index.sorted_blocks``), so a hot
    group is spread by the position of its rows, however sparse or dense their order
    values are.  A block's last row of a group takes the first row of the group's next
    block: the first rows come out of the same window (``lag`` is NULL), and a
    ``lead`` over the blocks of a group, at most one per partition, pairs them."""
    keyed = sorted_blocks(df, [group], [F.col(c).asc_nulls_first() for c in order], "_block", blocks)
    w = Window.partitionBy(group, "_block").orderBy(*order)
    inner = keyed.select("*", *[F.lead(c).over(w).alias(f"_n_{c}") for c in carry],
                         F.lead(F.lit(1)).over(w).isNull().alias("_last"),
                         F.lag(F.lit(1)).over(w).isNull().alias("_first"))
    firsts = inner.filter("_first").select(group, "_block", F.struct(*[F.col(c) for c in carry]).alias("_f"))
    wr = Window.partitionBy(group).orderBy("_block")
    stitch = firsts.select(group, "_block", F.lead("_f").over(wr).alias("_nf")).filter(F.col("_nf").isNotNull())
    joined = inner.join(stitch, [group, "_block"], "left")
    return joined.select(
        *df.columns,
        *[F.when(F.col("_last"), F.col("_nf")[c]).otherwise(F.col(f"_n_{c}")).alias(f"next_{c}")
          for c in carry])


def trip_edges(movements: DataFrame, blocks: int | None = None) -> DataFrame:
    """Hop graph ``(src, dst)``: consecutive stops of every trip in stop
    index order (gaps in the index are bridged), self-loops dropped, each
    edge once."""
    stops = _stops(movements)
    nxt = next_in_group(stops, "trip_key", ["stop_index", "station_name"], ["station_name"], blocks)
    nxt = nxt.select(F.col("station_name").alias("src"), F.col("next_station_name").alias("dst"))
    return nxt.filter(F.col("dst").isNotNull() & (F.col("src") != F.col("dst"))).distinct()


def timed_connections(movements: DataFrame, blocks: int | None = None) -> DataFrame:
    """Timed graph as flat rows ``(src, dst, dp_time, ar_time, trip_key)``:
    departure at this stop, planned arrival at the next stop of the trip.
    Hops without both times, self-loops and hops arriving before they
    depart are dropped."""
    stops = _stops(movements, "planned_arrival_time", "planned_departure_time")
    order = ["stop_index", "station_name", "planned_arrival_time", "planned_departure_time"]
    paired = next_in_group(stops, "trip_key", order, ["station_name", "planned_arrival_time"], blocks)
    nxt = paired.select(
        F.col("station_name").alias("src"), F.col("next_station_name").alias("dst"),
        F.col("planned_departure_time").alias("dp_time"),
        F.col("next_planned_arrival_time").alias("ar_time"), "trip_key")
    return nxt.filter(F.col("dst").isNotNull() & (F.col("src") != F.col("dst"))
                      & F.col("dp_time").isNotNull() & F.col("ar_time").isNotNull()
                      & (F.col("ar_time") >= F.col("dp_time")))


def edge_connections(connections: DataFrame, bucket: str = "hour") -> DataFrame:
    """Nested form: per edge and departure ``bucket`` (``date_trunc`` unit)
    the connections sorted by departure.  Bucketing keeps each array to
    the trains of one edge in one period rather than a whole edge."""
    b = _truncate_ntz("dp_time", bucket)
    return connections.groupBy("src", "dst", b.alias("period")).agg(
        F.count(F.lit(1)).alias("n_connections"),
        F.sort_array(F.collect_list(F.struct("dp_time", "ar_time", "trip_key"))).alias("connections"))


PAGE = 1024            # connections on a page of an edge's list


def edge_lists(connections: DataFrame, page: int = PAGE) -> DataFrame:
    """The one sorted list of connections of every edge, in pages: ``src, dst, page,
    n_connections, connections``.  Page k holds the connections k * page to
    (k + 1) * page - 1 of the edge in order of departure (then arrival, trip), so the
    pages in order are the list, and no array is longer than a page."""
    order = ["dp_time", "ar_time", "trip_key"]
    rows = with_position(connections.select("src", "dst", *order), ["src", "dst"], order, "_at")
    return rows.groupBy("src", "dst", F.floor(F.col("_at") / page).alias("page")).agg(
        F.count(F.lit(1)).alias("n_connections"),
        F.sort_array(F.collect_list(F.struct(*order))).alias("connections"))


def _truncate_ntz(col: str, unit: str):
    """Wall-clock truncation of a TIMESTAMP_NTZ (``date_trunc`` would go
    through the session time zone and return a zoned timestamp)."""
    c = F.col(col)
    zero = F.lit(0)
    if unit == "hour":
        return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), zero, zero)
    if unit == "day":
        return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), zero, zero, zero)
    return F.date_trunc(unit, c).cast("timestamp_ntz")


def _bucket(col: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(col)), F.lit(buckets)).cast("int")


def _prepare(edges: DataFrame, buckets: int | None = None) -> DataFrame:
    """The search's edge side, materialized once.

    Default: checkpointed in balanced (round-robin) partitions.
    ``buckets=N``: written as a table in the session's checkpoint folder,
    partitioned by ``_b`` = hash(src) mod N.  Each round then reads only
    the bucket folders its frontier touches (``_touched``: at most N bucket
    ids, a partition filter) and joins on the bucket too, instead of
    scanning the whole table -- for very large timetables with narrow
    frontiers."""
    spark = edges.sparkSession
    folder = ensure_checkpoint_dir(spark)
    if not buckets:
        return edges.repartition(spark.sparkContext.defaultParallelism).checkpoint(eager=True)
    path = f"{folder.rstrip('/')}/railflow-search-{uuid.uuid4().hex}"
    edges.withColumn("_b", _bucket("src", buckets)).write.partitionBy("_b").parquet(path)
    return spark.read.parquet(path)


def _probe(frontier: DataFrame, buckets: int | None) -> DataFrame:
    return frontier.withColumn("_fb", _bucket("station_name", buckets)) if buckets else frontier


def _touched(table: DataFrame, probe: DataFrame, buckets: int | None) -> DataFrame:
    """The bucket folders of ``table`` this round needs (partition pruning)."""
    if not buckets:
        return table
    ids = [r[0] for r in probe.select("_fb").distinct().collect()]   # at most ``buckets`` values
    return table.filter(F.col("_b").isin(ids))


def _on_station(frontier_station, edge_src, buckets: int | None):
    cond = frontier_station == edge_src
    return cond & (F.col("_fb") == F.col("_b")) if buckets else cond


def _present(edges: DataFrame, *wanted: DataFrame) -> DataFrame:
    """``station_name``: the wanted stations (one column each) that the graph has."""
    ends = edges.select(F.col("src").alias("station_name")).union(edges.select(F.col("dst").alias("station_name")))
    names = functools.reduce(DataFrame.union, wanted).toDF("station_name").distinct()
    return ends.join(names, "station_name", "left_semi").distinct()


def _union(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


class _Levels:
    """What each round of a search found, one folder a round in the session's
    checkpoint folder: a round writes its own rows only, and all rounds are read as
    one table (the round is the folder's column)."""

    def __init__(self, spark, label: str, level: str):
        self.spark, self.level, self.schema = spark, level, None
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/railflow-{label}-{uuid.uuid4().hex}"

    def add(self, rows: DataFrame, number: int) -> DataFrame:
        """Write the rows of a round; what was written."""
        rows.write.parquet(f"{self.path}/{self.level}={number}")
        self.schema = rows.schema
        return self.only(number)

    def only(self, number: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{self.level}={number}")

    def all(self) -> DataFrame:
        schema = StructType([*self.schema.fields, StructField(self.level, IntegerType())])
        return self.spark.read.schema(schema).parquet(self.path)

    def drop(self) -> None:
        remove(self.spark, self.path)


CHAINED = 8      # joins that one plan chains before its result is checkpointed


def _next_level(frontier: DataFrame, seen: DataFrame, edges: DataFrame, buckets: int | None,
                ranked: bool = True) -> DataFrame:
    """One breadth-first step: ``source, station_name, prev, rank`` of the stations
    first reached from ``frontier``.

    ``rank`` orders the best paths of one level: paths of equal length compare by the
    rank of the station before, then by the last station.  The rows are sorted so and
    numbered in that order (partition number and place: order-preserving, not dense),
    so that no path is ever carried along.  Without ``ranked`` the least station
    before is taken, and all ranks are 0."""
    probe = _probe(frontier, buckets)
    best = (probe.join(_touched(edges, probe, buckets), _on_station(F.col("station_name"), F.col("src"), buckets))
            .groupBy("source", "dst").agg(F.min(F.struct("rank", F.col("station_name").alias("prev"))).alias("m")))
    new = best.withColumnRenamed("dst", "station_name").join(seen, ["source", "station_name"], "left_anti")
    if not ranked:
        return new.select("source", "station_name", F.col("m.prev").alias("prev"), F.lit(0).cast("long").alias("rank"))
    return new.orderBy("source", "m.rank", "station_name").select(
        "source", "station_name", F.col("m.prev").alias("prev"), F.monotonically_increasing_id().alias("rank"))


def _seeds(sources: DataFrame) -> DataFrame:
    return sources.select("source", F.col("source").alias("station_name"), F.lit(None).cast("string").alias("prev"),
                          F.lit(0).cast("long").alias("rank"))


def _reach_all(edges: DataFrame, sources: DataFrame, buckets: int | None) -> DataFrame:
    """Best paths from each source to every station it reaches."""
    levels = _Levels(edges.sparkSession, "bfs", "hops")
    frontier, hops = levels.add(_seeds(sources), 0), 0
    while not frontier.isEmpty():
        seen = levels.all().select("source", "station_name")
        t0 = time.perf_counter()
        hops += 1
        frontier = levels.add(_next_level(frontier, seen, edges, buckets), hops)
        log.debug("bfs round %d: %.2fs", hops, time.perf_counter() - t0)
    # the paths are put together once, level by level: no more rows than the result
    paths = levels.only(0).select("source", "station_name", F.lit(0).alias("hops"), F.array("source").alias("path"))
    parts = [paths]
    for h in range(1, hops):
        before = paths.select("source", F.col("station_name").alias("prev"), F.col("path").alias("_before"))
        paths = levels.only(h).join(before, ["source", "prev"]).select(
            "source", "station_name", F.lit(h).alias("hops"), F.concat("_before", F.array("station_name")).alias("path"))
        if h % CHAINED == 0:
            paths = paths.checkpoint()
        parts.append(paths)
    found = _union(parts).checkpoint()
    levels.drop()
    return found


def _reach_pairs(edges: DataFrame, pairs: DataFrame, buckets: int | None, reverse: DataFrame) -> DataFrame:
    """Best path of every (source, target) pair by a search from both ends.

    Each round the side with the smaller frontier takes one step, for the sources
    (targets) of open pairs only.  A pair of distance d is met exactly when the depths
    of both sides add up to d, by a station on both frontiers.  From the source the
    best prefix is known by its rank; from the target the best suffix goes to the
    least next station; prefixes to different stations differ, so the least rank wins."""
    spark = edges.sparkSession
    sides = {"source": _Levels(spark, "bfs-from", "hops"), "target": _Levels(spark, "bfs-to", "hops")}
    fronts = {side: levels.add(_seeds(pairs.select(F.col(side).alias("source")).distinct()), 0)
              for side, levels in sides.items()}
    sizes = {side: f.count() for side, f in fronts.items()}
    depth, meetings, open_pairs, closed = {"source": 0, "target": 0}, [], pairs, False
    while True:
        # pairs whose frontiers both go on, and where these meet (one row per pair)
        here = fronts["source"].select("source", "station_name", "rank")
        there = fronts["target"].select(F.col("source").alias("target"), "station_name")
        meet = open_pairs.join(here, "source").join(there, ["target", "station_name"])
        turn = depth["source"] + depth["target"]
        if turn % CHAINED == CHAINED - 1 or not meet.isEmpty():
            closed = True
            met = meet.groupBy("source", "target").agg(F.min(F.struct("rank", "station_name")).alias("m"))
            status = (open_pairs.join(here, "source", "left_semi").join(there, "target", "left_semi")
                      .join(met, ["source", "target"], "left")
                      .select("source", "target", F.col("m.station_name").alias("middle"),
                              F.lit(depth["source"]).alias("before"), F.lit(depth["target"]).alias("after")).checkpoint())
            meetings.append(status.filter("middle IS NOT NULL"))
            open_pairs = status.filter("middle IS NULL").select("source", "target")
            if open_pairs.isEmpty():
                break
        side = min(sizes, key=sizes.get)
        levels, depth[side], frontier = sides[side], depth[side] + 1, fronts[side]
        if closed:       # go on for open pairs only
            frontier = frontier.join(open_pairs.select(F.col(side).alias("source")), "source", "left_semi")
        seen = levels.all().select("source", "station_name")
        if side == "source":
            step = _next_level(frontier, seen, edges, buckets)
        else:
            # towards the target the best next station is simply the least
            step = _next_level(frontier, seen, reverse, buckets, ranked=False)
        fronts[side] = levels.add(step, depth[side])
        sizes[side] = fronts[side].count()
        if not sizes[side]:      # no pair is left that could meet
            break
    nothing = pairs.select("source", "target", F.lit("").alias("middle"), F.lit(0).alias("before"), F.lit(0).alias("after")).limit(0)
    walks = _union(meetings or [nothing]).withColumns({"path": F.array("middle"), "first": F.col("middle"), "last": F.col("middle")})
    for number, h in enumerate(range(depth["source"], 0, -1), 1):
        step = sides["source"].only(h).select("source", F.col("station_name").alias("first"), "prev")
        walks = walks.join(step, ["source", "first"], "left")
        inside = F.col("before") >= h
        walks = walks.withColumns({"path": F.when(inside, F.concat(F.array("prev"), "path")).otherwise(F.col("path")),
                                   "first": F.when(inside, F.col("prev")).otherwise(F.col("first"))}).drop("prev")
        walks = walks.checkpoint() if number % CHAINED == 0 else walks
    for number, h in enumerate(range(depth["target"], 0, -1), 1):
        step = sides["target"].only(h).select(F.col("source").alias("target"), F.col("station_name").alias("last"), "prev")
        walks = walks.join(step, ["target", "last"], "left")
        inside = F.col("after") >= h
        walks = walks.withColumns({"path": F.when(inside, F.concat("path", F.array("prev"))).otherwise(F.col("path")),
                                   "last": F.when(inside, F.col("prev")).otherwise(F.col("last"))}).drop("prev")
        walks = walks.checkpoint() if number % CHAINED == 0 else walks
    found = walks.select("source", F.col("target").alias("station_name"),
                         (F.col("before") + F.col("after")).alias("hops"), "path").checkpoint()
    for levels in sides.values():
        levels.drop()
    return found


def shortest_paths_batch(edges: DataFrame, requests: DataFrame, buckets: int | None = None) -> DataFrame:
    """Breadth-first search for many requests in one loop.

    ``requests``: ``source`` and optionally ``target``.  Returns ``source,
    station_name, hops, path``: for a request with a target only that
    station, otherwise every station reached.  Among equally short paths the
    smallest path array wins.

    Requests without a target share one search keyed by (source, station); the state
    holds a predecessor and a rank per station, never a path.  Requests with a target
    are searched from both ends.  ``buckets``: see ``_prepare`` (partition-pruned edge
    reads)."""
    e = _prepare(edges.select("src", "dst").distinct(), buckets)
    has_target = "target" in requests.columns
    req = requests.select("source", F.col("target") if has_target else F.lit(None).cast("string").alias("target"))
    req = req.filter(F.col("source").isNotNull()).distinct().checkpoint()
    pairs = req.filter(F.col("target").isNotNull())
    # a station reaches itself only if the graph has it; other unknown names lead nowhere
    alone = req.filter(F.col("target").isNull() | (F.col("source") == F.col("target")))
    everything, found = req.filter(F.col("target").isNull()).select("source"), []
    if not alone.isEmpty():
        nodes = _present(e, alone.select("source")).checkpoint()
        everything = everything.join(nodes, F.col("source") == F.col("station_name"), "left_semi")
        pairs = pairs.join(nodes, F.col("source") == F.col("station_name"), "left").filter(
            (F.col("source") != F.col("target")) | F.col("station_name").isNotNull()).select("source", "target").checkpoint()
        if not everything.isEmpty():
            found.append(_reach_all(e, everything, buckets))
    if has_target and not pairs.isEmpty():
        back = e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
        found.append(_reach_pairs(e, pairs, buckets, _prepare(back, buckets) if buckets else back))
    if not found:
        return req.select("source", F.col("source").alias("station_name"), F.lit(0).alias("hops"),
                          F.array("source").alias("path")).limit(0)
    # a source may be asked for everything and for a target
    return found[0] if len(found) == 1 else _union(found).dropDuplicates(["source", "station_name"])


def _param_frame(spark, rows: list[tuple], schema: str) -> DataFrame:
    # query parameters as a tiny DataFrame (one row per request)
    return spark.createDataFrame(rows, schema)


def shortest_paths(edges: DataFrame, source: str, target: str | None = None,
                   buckets: int | None = None) -> DataFrame:
    """Q7: fewest-hop paths from one ``source``: ``station_name, hops, path``
    for every reached station, or only ``target`` (searched from both ends;
    empty when unreachable or unknown)."""
    req = _param_frame(edges.sparkSession, [(source, target)], "source string, target string")
    return shortest_paths_batch(edges, req, buckets).drop("source")


def _ntz_literal(value):
    text = value.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(value, datetime) else str(value)
    return F.lit(text).cast("timestamp_ntz")   # text -> NTZ: no zone involved


REQUEST_KEY = ["source", "departure"]
CELL_ROWS = 4          # departures of an edge in one cell, on average
COARSE = 1024          # cells whose departures meet in one window
STEP = 4096            # cells that a row is copied into at once


def _seconds(col) -> Column:
    """Wall-clock seconds: whole and monotone, without any zone."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.unix_date(F.to_date(c)) * F.lit(86400).cast("long") + F.hour(c) * 3600 + F.minute(c) * 60
            + F.second(c)).cast("long")


def departure_index(connections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The suffix-minimum index of timed connections, and its clock.

    The departures of a station are cut into cells of equal time, about ``CELL_ROWS``
    departures per edge (``clock``: src, start, width).  The index (src, cell, dst,
    dp_time, ar_time, trip_key) holds every connection in its own cell and, for every
    edge and cell, the connection that arrives first of those that leave in *later*
    cells.  Who reaches a station in some cell meets, per outgoing edge, that one row
    and the few departures of the cell, however many trains run later.  The index is
    at most about 1 + 1 / CELL_ROWS as long as the connections; a busy edge is
    spread over its cells, and its windows over ranges of COARSE cells."""
    ride = F.struct("ar_time", "dp_time", "trip_key")
    c = connections.select("src", "dst", "dp_time", "ar_time", "trip_key", _seconds("dp_time").alias("_s"))
    edges = c.groupBy("src", "dst").agg(F.count("*").alias("n"), F.min("_s").alias("lo"), F.max("_s").alias("hi"))
    clock = edges.groupBy("src").agg(F.sum("n").alias("n"), F.count("*").alias("degree"), F.min("lo").alias("start"),
                                     F.max("hi").alias("end"))
    cells = F.ceil(F.col("n") / (F.col("degree") * CELL_ROWS))
    clock = clock.select("src", "start", (F.floor((F.col("end") - F.col("start")) / cells) + 1).cast("long").alias("width"))
    own = c.join(clock, "src").select("src", _cell(F.col("_s")).alias("cell"), "dst", "dp_time", "ar_time", "trip_key")
    coarse = F.floor(F.col("cell") / COARSE).alias("_r")
    best = own.groupBy("src", "dst", "cell").agg(F.min(ride).alias("_best")).select("*", coarse)
    inside = Window.partitionBy("src", "dst", "_r")
    best = best.select("*", F.min("_best").over(inside.orderBy(F.col("cell").desc())).alias("_from"),
                       F.lag("cell").over(inside.orderBy("cell")).alias("_prev"))
    ranges = best.groupBy("src", "dst", "_r").agg(F.min("_best").alias("_top"), F.max("cell").alias("_end"))
    across = Window.partitionBy("src", "dst").orderBy("_r")
    later = Window.partitionBy("src", "dst").orderBy(F.col("_r").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("src", "dst", "_r", F.min("_top").over(later).alias("_later"), F.lag("_end").over(across).alias("_before"))
    best = best.join(ranges, ["src", "dst", "_r"]).select(
        "src", "dst", F.col("cell").alias("_to"), F.coalesce("_prev", "_before", F.lit(0)).alias("_lo"),
        F.when(F.col("_later") < F.col("_from"), F.col("_later")).otherwise(F.col("_from")).alias("_ride"))
    best = best.select("src", "dst", "_to", "_lo", *[F.col(f"_ride.{c}").alias(c) for c in ("dp_time", "ar_time", "trip_key")])
    # valid in the cells from the last one with a departure up to the one before its own
    best = best.where("_lo < _to").withColumn("_chunk", F.explode(F.sequence(
        F.floor(F.col("_lo") / STEP), F.floor((F.col("_to") - 1) / STEP))))
    later_rows = best.select("src", F.explode(F.sequence(
        F.greatest("_lo", F.col("_chunk") * STEP), F.least(F.col("_to") - 1, F.col("_chunk") * STEP + STEP - 1))).alias("cell"),
        "dst", "dp_time", "ar_time", "trip_key")
    return own.unionByName(later_rows.select(*own.columns)), clock


def _cell(seconds) -> Column:
    """Cell of a time at the station whose clock (start, width) is in the row."""
    return F.floor(F.greatest(seconds - F.col("start"), F.lit(0)) / F.col("width")).cast("long")


def rides_from(frontier: DataFrame, index: DataFrame, clock: DataFrame, buckets: int | None = None) -> DataFrame:
    """Candidate rides of (request, station_name, earliest_arrival) rows: per outgoing
    edge the departures of the arrival's cell that can still be caught, and the best
    later one."""
    timed = frontier.join(clock, F.col("station_name") == F.col("src")).select(
        *frontier.columns, _cell(_seconds("earliest_arrival")).alias("_at"))
    probe = _probe(timed, buckets).alias("f")
    c = _touched(index, probe, buckets).alias("c")
    return probe.join(c, _on_station(F.col("f.station_name"), F.col("c.src"), buckets) & (F.col("c.cell") == F.col("f._at"))
                      & (F.col("c.dp_time") >= F.col("f.earliest_arrival"))).select(
        *[F.col(f"f.{k}").alias(k) for k in REQUEST_KEY], F.col("c.dst").alias("station_name"),
        F.col("c.ar_time").alias("a"), F.col("c.dp_time").alias("d"), F.col("c.src").alias("u"), F.col("c.trip_key").alias("t"))


def earliest_arrivals_batch(connections: DataFrame, requests: DataFrame, buckets: int | None = None) -> DataFrame:
    """Earliest arrivals for many ``(source, departure)`` requests in one loop.

    Returns ``source, departure, station_name, earliest_arrival, round,
    prev, prev_departure, prev_trip`` for every station reachable from the
    source when leaving at ``departure`` or later.  A connection is usable
    from a station if it departs at or after the arrival there; transfers
    take no time.

    Each round looks the (request, station) pairs improved in the previous round up
    in ``departure_index``, keeps the best arrival per (request, station) (ties: least
    departure, source station, trip) and writes the strict improvements, nothing else;
    only keys that a ride reached are compared with earlier rounds.  It ends at the
    fixpoint (never later than a departure-ordered scan).  ``prev`` is the station the final
    improvement came from: along ``prev`` links arrivals never increase and
    equal arrivals have strictly smaller rounds, so the links form a tree
    rooted at the source."""
    spark = connections.sparkSession
    req = (requests.select("source", F.col("departure").cast("timestamp_ntz").alias("departure"))
           .filter(F.col("source").isNotNull() & F.col("departure").isNotNull()).distinct().checkpoint())
    # one value: connections departing before every request are useless
    earliest = req.select(F.min("departure").cast("string")).first()[0]
    conn = connections.select("src", "dst", "dp_time", "ar_time", "trip_key").checkpoint()
    known = req.join(_present(conn, req.select("source")), F.col("source") == F.col("station_name"), "left_semi")
    if earliest is not None:
        conn = conn.filter(F.col("dp_time") >= F.lit(earliest).cast("timestamp_ntz"))
    index, clock = departure_index(conn)
    index, clock = _prepare(index, buckets), clock.checkpoint()
    none_s = F.lit(None).cast("string")
    rounds = _Levels(spark, "arrivals", "round")
    improved = rounds.add(known.select(
        "source", "departure", F.col("source").alias("station_name"), F.col("departure").alias("earliest_arrival"),
        none_s.alias("prev"), F.lit(None).cast("timestamp_ntz").alias("prev_departure"), none_s.alias("prev_trip")), 0)
    rnd, key = 0, REQUEST_KEY + ["station_name"]
    while not improved.isEmpty():
        rnd += 1
        t0 = time.perf_counter()
        rides = rides_from(improved.select(*key, "earliest_arrival"), index, clock, buckets)
        reach = rides.groupBy(*key).agg(F.min(F.struct("a", "d", "u", "t")).alias("m"))
        old = rounds.all().select(*key, F.col("earliest_arrival").alias("_old"))
        reach = reach.join(old, key, "left").groupBy(*key).agg(F.min("m").alias("m"), F.min("_old").alias("_old"))
        reach = reach.filter(F.col("_old").isNull() | (F.col("m.a") < F.col("_old")))
        improved = rounds.add(reach.select(*key, F.col("m.a").alias("earliest_arrival"), F.col("m.u").alias("prev"),
                                           F.col("m.d").alias("prev_departure"), F.col("m.t").alias("prev_trip")), rnd)
        log.debug("earliest-arrival round %d: %.2fs", rnd, time.perf_counter() - t0)
    # every improvement is strict, so the least arrival is the last one
    last = rounds.all().groupBy(*key).agg(F.min(F.struct(
        "earliest_arrival", "round", "prev", "prev_departure", "prev_trip")).alias("m"))
    best = last.select(*key, "m.*").checkpoint()
    rounds.drop()
    return best


def earliest_arrivals(connections: DataFrame, source: str, departure: datetime | str,
                       buckets: int | None = None) -> DataFrame:
    """Earliest arrival at every station reachable from one ``source``
    leaving at ``departure``: ``station_name, earliest_arrival, round,
    prev, prev_departure, prev_trip``."""
    spark = connections.sparkSession
    req = _param_frame(spark, [(source,)], "source string").select(
        "source", _ntz_literal(departure).alias("departure"))
    return earliest_arrivals_batch(connections, req, buckets).drop(*REQUEST_KEY)


def arrival_paths(best: DataFrame, targets: DataFrame, key=tuple(REQUEST_KEY)) -> DataFrame:
    """Walk ``prev`` links back from each target, all requests at once:
    ``targets`` has ``key`` columns and ``target``; returns ``key, target,
    earliest_arrival, path`` (unreachable targets are left out).

    Each round is one join of the open walks with ``best``; the number of
    rounds is the longest path's hop count."""
    key = list(key)
    b = best.select(*key, "station_name", "earliest_arrival", "prev")
    walks = (targets.join(b.withColumnRenamed("station_name", "target"), key + ["target"])
             .select(*key, "target", "earliest_arrival", F.array("target").alias("path"),
                     F.col("prev").alias("_at")).checkpoint())
    done = [walks.filter(F.col("_at").isNull())]
    walks = walks.filter(F.col("_at").isNotNull())
    while walks.count() > 0:
        step = (walks.join(b.select(*key, F.col("station_name").alias("_at"), F.col("prev").alias("_next")),
                           key + ["_at"])
                .select(*key, "target", "earliest_arrival", F.concat("path", F.array("_at")).alias("path"),
                        F.col("_next").alias("_at")).checkpoint())
        done.append(step.filter(F.col("_at").isNull()))
        walks = step.filter(F.col("_at").isNotNull())
    out = _union(done)
    return out.select(*key, "target", "earliest_arrival", F.reverse("path").alias("path"))


def earliest_arrival(connections: DataFrame, source: str, target: str, departure) -> DataFrame:
    """Q8: earliest arrival at ``target`` and one path achieving it:
    ``earliest_arrival, path`` (one row; empty when unreachable)."""
    spark = connections.sparkSession
    req = _param_frame(spark, [(source, target)], "source string, target string").select(
        "source", _ntz_literal(departure).alias("departure"), "target")
    best = earliest_arrivals_batch(connections, req.select(*REQUEST_KEY))
    return arrival_paths(best, req).select("earliest_arrival", "path")
