"""Distance used by the nearest-station search: Euclidean in degrees
(no longitude shrinkage), as the station feed's coordinates are compared."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def degree_distance(lat, lon, lat0, lon0) -> Column:
    dlat = _c(lat).cast("double") - _c(lat0).cast("double")
    dlon = _c(lon).cast("double") - _c(lon0).cast("double")
    return F.sqrt(F.pow(dlat, F.lit(2)) + F.pow(dlon, F.lit(2)))
