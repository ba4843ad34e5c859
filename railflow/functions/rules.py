"""Field rules of the timetable feed (cancellation, platforms, paths)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event status marking a cancellation, path separator,
# and the text that means "no" in the station feed.
CANCELLED_STATUS = "c"
PATH_SEPARATOR = "|"
NO_TEXT = "no"

PLATFORM_RULES = ("parquet", "star")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _event_cancelled(ev: Column) -> Column:
    return F.coalesce(ev["_cs"] == F.lit(CANCELLED_STATUS), F.lit(False)) | ev["_clt"].isNotNull()


def is_cancelled(ar, dp) -> Column:
    """Status ``c`` or a cancellation time on the arrival or the departure."""
    return _event_cancelled(_c(ar)) | _event_cancelled(_c(dp))


def planned_platform(ar, dp) -> Column:
    """Departure platform replaces the arrival one whenever a departure
    element exists, even when its platform is missing."""
    ar, dp = _c(ar), _c(dp)
    return F.when(dp.isNotNull(), dp["_pp"]).otherwise(ar["_pp"])


def changed_platform(ar, dp, rule: str = "star") -> Column:
    """Platform of one change element.

    ``parquet``: the arrival's ``cp``, replaced by the departure's ``cp``
    (even NULL) when the departure carries a changed time.
    ``star``: the departure's ``cp`` when it has a changed time and a
    platform, else the arrival's ``cp``."""
    ar, dp = _c(ar), _c(dp)
    if rule == "parquet":
        return F.when(dp["_ct"].isNotNull(), dp["_cp"]).otherwise(ar["_cp"])
    if rule == "star":
        return F.coalesce(F.when(dp["_ct"].isNotNull(), dp["_cp"]), ar["_cp"])
    raise ValueError(f"platform rule must be one of {PLATFORM_RULES}, got {rule!r}")


def path_origin(path) -> Column:
    return F.split_part(_c(path), F.lit(PATH_SEPARATOR), F.lit(1))


def path_destination(path) -> Column:
    return F.split_part(_c(path), F.lit(PATH_SEPARATOR), F.lit(-1))


def text_flag(text) -> Column:
    """Station-feed text to boolean: ``no`` is false, any other value true."""
    return _c(text) != F.lit(NO_TEXT)
