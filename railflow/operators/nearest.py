"""Nearest station.

Single position: a top-1 over one scan of the stations
(``TakeOrderedAndProject``: each task keeps its own best row).

Many positions: an exact search down a tree of station boxes, whatever the number and
the spread of the stations.  The stations' distinct positions (the least name stands
for a position) are cut at quantiles into ``SPLIT`` strips by longitude and each strip
into ``SPLIT`` cells by latitude, and so on, until a cell holds about ``LEAF``
positions.  The cut follows the stations, so one station far off does not coarsen the
cells of the others, and the depth is the logarithm of their number.  All positions go
down the tree together, a level per round: the nearest of the farthest corners of
the boxes bounds the answer from above, and boxes that are farther than that are left.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railflow.functions.geo import degree_distance
from railflow.session import ensure_checkpoint_dir

SPLIT = 4        # strips of a node, and cells of a strip
LEAF = 16        # positions in a leaf, about


def nearest_station(stations: DataFrame, latitude: float, longitude: float,
                    name_col: str = "name") -> DataFrame:
    """Closest station to one position (ties by name): ``name, latitude, longitude``."""
    dist = degree_distance("latitude", "longitude", F.lit(float(latitude)), F.lit(float(longitude)))
    return (_located(stations, name_col).orderBy(dist.asc(), F.col(name_col).asc()).limit(1)
            .select(F.col(name_col).alias("name"), "latitude", "longitude"))


def _located(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with finite coordinates."""
    out = df.select(*columns, F.col("latitude").cast("double").alias("latitude"),
                    F.col("longitude").cast("double").alias("longitude"))
    ok = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")) for c in ("latitude", "longitude")]
    return out.filter(ok[0] & ok[1])


def _box(lat_low, lat_high, lon_low, lon_high) -> list[Column]:
    return [F.min(lat_low).alias("lat0"), F.max(lat_high).alias("lat1"), F.min(lon_low).alias("lon0"), F.max(lon_high).alias("lon1")]


def station_tree(stations: DataFrame, leaf: int = LEAF) -> tuple[DataFrame, list[DataFrame]]:
    """(positions with their leaf ``node``, boxes of every level from the root's
    children down): node numbers of a level count SPLIT * SPLIT per parent."""
    spots = stations.groupBy("latitude", "longitude").agg(F.min("name").alias("name")).withColumn(
        "node", F.lit(0).cast("long")).checkpoint()
    fan = SPLIT * SPLIT
    levels = max(0, round(math.log(max(spots.count(), 1) / leaf, fan)))
    shares = [i / SPLIT for i in range(1, SPLIT)]

    def cut(rows: DataFrame, by: list[str], column: str, name: str) -> DataFrame:
        bounds = rows.groupBy(*by).agg(F.percentile_approx(column, shares, 200).alias("_q"))
        place = F.size(F.filter("_q", lambda q: q < F.col(column)))
        return rows.join(bounds, by).withColumn(name, place).drop("_q")

    for _ in range(levels):
        spots = cut(cut(spots, ["node"], "longitude", "_strip"), ["node", "_strip"], "latitude", "_cell")
        spots = spots.withColumn("node", F.col("node") * fan + F.col("_strip") * SPLIT + F.col("_cell")).drop("_strip", "_cell")
    if levels:
        spots = spots.checkpoint()
    boxes = [spots.groupBy("node").agg(*_box("latitude", "latitude", "longitude", "longitude"))]
    for _ in range(levels - 1):
        up = F.floor(F.col("node") / fan).alias("node")
        boxes.insert(0, boxes[0].groupBy(up).agg(*_box("lat0", "lat1", "lon0", "lon1")))
    return spots, boxes if levels else []


def nearest_stations(points: DataFrame, stations: DataFrame, leaf: int = LEAF) -> DataFrame:
    """For every row of ``points`` (``point_id, latitude, longitude``) one row
    ``point_id, name, distance``; ties by name.  Name and distance are NULL where
    the position is missing or not finite, or there is no station."""
    ensure_checkpoint_dir(points.sparkSession)
    spots, boxes = station_tree(_located(stations, "name"), leaf)
    rows = points.select("point_id", F.col("latitude").cast("double").alias("latitude"),
                         F.col("longitude").cast("double").alias("longitude")).withColumn(
        "_row", F.monotonically_increasing_id()).checkpoint()      # point_id may repeat
    lat, lon, zero = F.col("latitude"), F.col("longitude"), F.lit(0.0)
    at = _located(rows, "_row").withColumn("_node", F.lit(0).cast("long"))
    for level in boxes:
        children = level.withColumn("_parent", F.floor(F.col("node") / (SPLIT * SPLIT)))
        pairs = at.join(children, F.col("_node") == F.col("_parent"))
        gap = lambda p, low, high: F.greatest(F.col(low) - p, p - F.col(high), zero)
        far = lambda p, low, high: F.greatest(F.abs(p - F.col(low)), F.abs(p - F.col(high)))
        size = lambda y, x: F.sqrt(y * y + x * x)
        pairs = pairs.select("_row", "latitude", "longitude", F.col("node").alias("_node"),
                             size(gap(lat, "lat0", "lat1"), gap(lon, "lon0", "lon1")).alias("_least"),
                             size(far(lat, "lat0", "lat1"), far(lon, "lon0", "lon1")).alias("_most"))
        # the few boxes of one position meet; a hair wider than the exact bound, against rounding
        bound = F.min("_most").over(Window.partitionBy("_row"))
        at = pairs.withColumn("_bound", bound).where(F.col("_least") * (1 - 1e-9) <= F.col("_bound")).select(
            "_row", "latitude", "longitude", "_node")
    found = at.join(spots.select("node", "name", F.col("latitude").alias("_slat"), F.col("longitude").alias("_slon")),
                    F.col("_node") == F.col("node"))
    key = F.struct(degree_distance("_slat", "_slon", "latitude", "longitude").alias("d"), F.col("name").alias("name"))
    best = found.groupBy("_row").agg(F.min(key).alias("_b"))
    return rows.select("_row", "point_id").join(best, "_row", "left").select(
        "point_id", F.col("_b.name").alias("name"), F.col("_b.d").alias("distance"))
