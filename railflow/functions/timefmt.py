"""Timestamps of the timetable feed.

All times are wall-clock ``TIMESTAMP_NTZ``: the feed carries no zone and a
session zone must not shift them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The feed's compact time format (two-digit year, month, day,
# hour, minute) and the snapshot-folder pattern (first run of ten digits).
STAMP_FORMAT = "yyMMddHHmm"
SNAPSHOT_PATTERN = r"(\d{10})"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_stamp(text) -> Column:
    """``yyMMddHHmm`` text -> TIMESTAMP_NTZ; NULL for missing or bad text.

    Two-digit years resolve to 2000-2099 (Spark's rule)."""
    return F.try_to_timestamp(_c(text), F.lit(STAMP_FORMAT)).cast("timestamp_ntz")


def format_stamp(ts) -> Column:
    return F.date_format(_c(ts), STAMP_FORMAT)


def snapshot_from_member(member) -> Column:
    """Snapshot time of an archive member ``YYMMDDHHMM/<station>/<file>``.

    The first ten-digit run of the path; NULL when absent (the caller
    quarantines such members instead of failing the job)."""
    digits = F.regexp_extract(_c(member), SNAPSHOT_PATTERN, 1)
    return parse_stamp(F.nullif(digits, F.lit("")))


def trip_start(stop_id) -> Column:
    """Trip start embedded in a stop id ``[-]<trip>-<yyMMddHHmm>-<index>``."""
    unsigned = F.regexp_replace(_c(stop_id), "^-", "")
    return parse_stamp(F.split_part(unsigned, F.lit("-"), F.lit(2)))


def minutes_between(start, end) -> Column:
    """Whole minutes from ``start`` to ``end``, truncated toward zero
    (negative when ``end`` is earlier); NULL if either side is NULL.

    Computed from the NTZ difference interval, whose fields all carry the
    sign, so no session time zone (and no DST shift) is involved."""
    iv = _c(end) - _c(start)
    field = lambda name: F.extract(F.lit(name), iv).cast("bigint")
    return (field("DAY") * 1440 + field("HOUR") * 60 + field("MINUTE")).cast("int")
