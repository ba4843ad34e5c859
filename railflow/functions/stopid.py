"""Stop identifiers: ``<trip number, may start with '-'>-<trip start>-<index>``.

The trip key is everything before the last ``-``; the stop index is the
integer after it.  Ids that do not end in ``-<digits>`` give NULLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STOP_ID_PATTERN = r"^(.*)-(\d+)$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trip_key(stop_id) -> Column:
    return F.nullif(F.regexp_extract(_c(stop_id), STOP_ID_PATTERN, 1), F.lit(""))


def stop_index(stop_id) -> Column:
    digits = F.nullif(F.regexp_extract(_c(stop_id), STOP_ID_PATTERN, 2), F.lit(""))
    return digits.try_cast("bigint")


def split_stop_id(stop_id) -> list[Column]:
    return [trip_key(stop_id).alias("trip_key"), stop_index(stop_id).alias("stop_index")]
