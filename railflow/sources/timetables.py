"""Timetable XML -> rows.

Documents arrive as a DataFrame ``(snapshot_ts, member, xml)`` (one row per
archive member).  Parsing is ``from_xml`` + ``explode``: JVM-side, one pass,
no Python.  Both the XML path and the driver-table analogs meet in the same
*element* form ``(snapshot_ts, member, station, eva_raw, s)`` where ``s`` is
one ``<s>`` element as a struct, so every rule below is written once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railflow import schemas
from railflow.functions.rules import (
    changed_platform, is_cancelled, path_destination, path_origin, planned_platform,
)
from railflow.functions.timefmt import parse_stamp

_XML_OPTIONS = {"mode": "PERMISSIVE"}


_PASS = ("archive", "snapshot_ts", "member")   # carried through when present


def _schema(kind: str) -> str:
    return schemas.PLANNED_XML_SCHEMA if kind == "planned" else schemas.CHANGE_XML_SCHEMA


def parse_documents(docs: DataFrame, kind: str = "planned") -> DataFrame:
    """Documents with their parsed content ``doc``; the text is kept only
    where it is ``malformed`` (no timetable with a ``station``, text that is
    not UTF-8, or a member without a snapshot time)."""
    keep = [c for c in _PASS if c in docs.columns]
    parsed = docs.select(*keep, "xml", F.from_xml("xml", _schema(kind), _XML_OPTIONS).alias("doc"))
    bad = F.col("doc._station").isNull()
    if "snapshot_ts" in docs.columns:
        bad = bad | F.col("snapshot_ts").isNull()
    parsed = parsed.withColumn("malformed", bad)
    return parsed.withColumn("xml", F.when(F.col("malformed"), F.col("xml")))


def quarantined(parsed: DataFrame) -> DataFrame:
    """The malformed documents of ``parse_documents``, with their text."""
    return parsed.filter("malformed").drop("doc", "malformed")


def malformed_documents(docs: DataFrame, kind: str = "planned") -> DataFrame:
    return quarantined(parse_documents(docs, kind))


def elements_of(parsed: DataFrame) -> DataFrame:
    """The ``<s>`` elements of well-formed documents (an empty timetable has none)."""
    valid = parsed.filter(~F.col("malformed"))
    member = F.col("member") if "member" in parsed.columns else F.lit(None).cast("string")
    archive = [F.col("archive")] if "archive" in parsed.columns else []
    return valid.select(
        *archive, "snapshot_ts", member.alias("member"),
        F.col("doc._station").alias("station"),
        F.col("doc._eva").try_cast("int").alias("eva_raw"),
        F.explode("doc.s").alias("s"),
    )


def planned_elements_from_xml(docs: DataFrame) -> DataFrame:
    return elements_of(parse_documents(docs, "planned"))


def change_elements_from_xml(docs: DataFrame) -> DataFrame:
    return elements_of(parse_documents(docs, "change"))


def planned_rows(elements: DataFrame) -> DataFrame:
    """One planned stop per ``<s>``: train label, planned times, path ends,
    planned platform and the cancellation flag."""
    s, ar, dp, tl = F.col("s"), F.col("s.ar"), F.col("s.dp"), F.col("s.tl")
    week = [F.col("archive")] if "archive" in elements.columns else []
    return elements.select(
        *week,
        F.col("snapshot_ts"),
        F.to_date("snapshot_ts").alias("snapshot_date"),
        F.hour("snapshot_ts").alias("snapshot_hour"),
        F.minute("snapshot_ts").alias("snapshot_minute"),
        F.col("member"),
        s["_id"].alias("stop_id"),
        F.col("station").alias("station_name"),
        F.col("eva_raw"),
        tl["_f"].alias("filter_flags"),
        tl["_t"].alias("trip_type"),
        tl["_o"].alias("owner"),
        tl["_c"].alias("trip_category"),
        tl["_n"].alias("train_number"),
        F.when(ar.isNotNull(), path_origin(ar["_ppth"])).alias("origin_station"),
        F.when(dp.isNotNull(), path_destination(dp["_ppth"])).alias("destination_station"),
        parse_stamp(ar["_pt"]).alias("planned_arrival_time"),
        parse_stamp(dp["_pt"]).alias("planned_departure_time"),
        is_cancelled(ar, dp).alias("cancelled"),
        planned_platform(ar, dp).alias("planned_platform"),
    )


def change_rows(elements: DataFrame, platform_rule: str = "star") -> DataFrame:
    """One change per ``<s>`` of a change snapshot.

    ``has_time`` tells whether the change carries a changed time (the narrow
    notion of a matched/unmatched change)."""
    ar, dp = F.col("s.ar"), F.col("s.dp")
    week = [F.col("archive")] if "archive" in elements.columns else []
    return elements.select(
        *week,
        F.col("snapshot_ts"),
        F.col("member"),
        F.col("s._id").alias("stop_id"),
        F.col("station").alias("station_name"),
        F.col("eva_raw"),
        parse_stamp(ar["_ct"]).alias("changed_arrival_time"),
        parse_stamp(dp["_ct"]).alias("changed_departure_time"),
        is_cancelled(ar, dp).alias("cancelled"),
        changed_platform(ar, dp, platform_rule).alias("changed_platform"),
        (ar["_ct"].isNotNull() | dp["_ct"].isNotNull()).alias("has_time"),
    )


def parse_planned(docs: DataFrame) -> DataFrame:
    return planned_rows(planned_elements_from_xml(docs))


def parse_changes(docs: DataFrame, platform_rule: str = "star") -> DataFrame:
    return change_rows(change_elements_from_xml(docs), platform_rule)
