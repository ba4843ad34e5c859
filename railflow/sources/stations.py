"""Station master data: one JSON document with root ``result: [...]``,
flattened to the 47 station columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railflow.functions.rules import text_flag
from railflow.schemas import STATION_JSON_SCHEMA

_BOOL_FLAGS = ["hasParking", "hasBicycleParking", "hasLocalPublicTransport", "hasPublicFacilities",
               "hasLockerSystem", "hasTaxiRank", "hasTravelNecessities"]
_BOOL_FLAGS_2 = ["hasWiFi", "hasTravelCenter", "hasRailwayMission", "hasDBLounge", "hasLostAndFound",
                 "hasCarRental"]


def _coord(arr, i: int):
    return F.get(arr["geographicCoordinates"]["coordinates"], i).cast("decimal(9,6)")


def station_columns(s) -> list:
    """Select list over one ``result`` element ``s`` (a struct Column).
    Missing paths give NULL (``get`` on arrays never fails)."""
    eva = F.get(s["evaNumbers"], 0)
    ril = F.get(s["ril100Identifiers"], 0)
    return [
        s["number"].alias("number"), s["ifopt"].alias("ifopt"), s["name"].alias("name"),
        s["mailingAddress"]["city"].alias("city"), s["mailingAddress"]["zipcode"].alias("zipcode"),
        s["mailingAddress"]["street"].alias("street"),
        s["category"].alias("category"), s["priceCategory"].alias("priceCategory"),
        *[s[c].alias(c) for c in _BOOL_FLAGS],
        s["hasSteplessAccess"].alias("hasSteplessAccess"),
        # "no" is false, anything else (also a missing value) true
        F.coalesce(text_flag(s["hasMobilityService"]), F.lit(True)).alias("hasMobilityService"),
        *[s[c].alias(c) for c in _BOOL_FLAGS_2],
        s["federalState"].alias("federalState"),
        s["regionalbereich"]["number"].alias("regionalbereich_number"),
        s["regionalbereich"]["name"].alias("regionalbereich_name"),
        s["regionalbereich"]["shortName"].alias("regionalbereich_shortName"),
        s["aufgabentraeger"]["shortName"].alias("aufgabentraeger_shortName"),
        s["aufgabentraeger"]["name"].alias("aufgabentraeger_name"),
        s["timeTableOffice"]["email"].alias("timeTableOffice_email"),
        s["timeTableOffice"]["name"].alias("timeTableOffice_name"),
        s["szentrale"]["number"].alias("szentrale_number"),
        s["szentrale"]["publicPhoneNumber"].alias("szentrale_publicPhoneNumber"),
        s["szentrale"]["name"].alias("szentrale_name"),
        s["stationManagement"]["number"].alias("stationManagement_number"),
        s["stationManagement"]["name"].alias("stationManagement_name"),
        eva["number"].alias("eva_number"),
        _coord(eva, 0).alias("longitude"), _coord(eva, 1).alias("latitude"),
        ril["rilIdentifier"].alias("rilIdentifier"),
        ril["hasSteamPermission"].alias("rilIdentifier_hasSteamPermission"),
        ril["steamPermission"].alias("rilIdentifier_steamPermission"),
        _coord(ril, 0).alias("rilIdentifier_longitude"), _coord(ril, 1).alias("rilIdentifier_latitude"),
        ril["primaryLocationCode"].alias("rilIdentifier_primaryLocationCode"),
        s["productLine"]["productLine"].alias("productLine"),
        s["productLine"]["segment"].alias("segment"),
    ]


def read_stations(spark: SparkSession, path: str, order_col: str | None = None) -> DataFrame:
    """The stations of JSON files; ``order_col`` adds each one's place (file, index)."""
    raw = spark.read.schema(STATION_JSON_SCHEMA).option("multiLine", True).json(path)
    rows = raw.select(F.input_file_name().alias("file"), F.posexplode("result").alias("at", "s"))
    order = [F.struct("file", "at").alias(order_col)] if order_col else []
    return rows.select(*station_columns(F.col("s")), *order)
