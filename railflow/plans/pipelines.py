"""The two ETL flows.

E1  documents -> ``train_movements`` (wide fact, Parquet, partitioned by
    snapshot date/hour/minute): policy ``max`` fold, ``parquet`` platform rule.
E2  documents -> star schema (``dim_station, dim_train, dim_date, dim_time``,
    ``fact_train_movements``, ``unmatched_timetable_changes``): first planned
    row per stop wins, policy ``last`` fold, ``star`` platform rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from railflow.operators.fold import fold_changes
from railflow.operators.merge import merge_movements
from railflow.operators.names import DEFAULT_PREFIX, lookup_table, resolve_names
from railflow.sources.timetables import change_rows, planned_rows


STATION_ORDER = "station_order"     # place of a station in its file, for names that stand in it twice


def resolve_planned(planned: DataFrame, stations: DataFrame, prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """``eva_number`` of each planned row from its (loosely spelled)
    station name; the document's own ``eva`` stays in ``eva_raw``."""
    order = STATION_ORDER if STATION_ORDER in stations.columns else None
    return resolve_names(planned, "station_name", lookup_table(stations, order_col=order), prefix, "eva_number")


def build_movements(planned_elements: DataFrame, change_elements: DataFrame, stations: DataFrame,
                    prefix: str = DEFAULT_PREFIX, policy: str = "max",
                    platform_rule: str = "parquet") -> DataFrame:
    planned = resolve_planned(planned_rows(planned_elements), stations, prefix)
    folded = fold_changes(change_rows(change_elements, platform_rule), policy)
    return merge_movements(planned, folded)


# ------------------------------------------------------------ raw inputs

def stage_documents(spark, paths, kind: str, path: str, archive_mode: str = "path") -> DataFrame:
    """Untar and parse the archives once into Parquet at ``path`` (a folder of
    the shared store); every table of the load is built from it."""
    from railflow.sources.archives import read_archives
    from railflow.sources.timetables import parse_documents

    parse_documents(read_archives(spark, paths, archive_mode), kind).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _stage_load(spark, planned_paths, change_paths, staging: str, archive_mode: str):
    """Planned and change elements of a load, and its malformed documents."""
    from railflow.operators.sinks import remove
    from railflow.sources.timetables import elements_of, quarantined

    remove(spark, staging)
    planned = stage_documents(spark, planned_paths, "planned", f"{staging}/planned", archive_mode)
    changes = stage_documents(spark, change_paths, "change", f"{staging}/changes", archive_mode)
    return elements_of(planned), elements_of(changes), quarantined(planned).unionByName(quarantined(changes))


def etl_movements(spark, planned_paths, change_paths, stations_path: str, out_path: str,
                  prefix: str = DEFAULT_PREFIX, policy: str = "max", platform_rule: str = "parquet",
                  archive_mode: str = "path", staging_path: str | None = None) -> DataFrame:
    """E1 end to end: one load of archives + station JSON merged into the
    ``train_movements`` stored at ``out_path`` (``plans.incremental``), together with
    its malformed documents and unmatched changes (``incremental.read_movements``).
    While the load runs, parsed documents lie at ``<out>_staging``.

    ``sinks.write_movements`` exports the result as a plain partitioned table."""
    from railflow.operators.sinks import remove
    from railflow.plans.incremental import load_movements
    from railflow.sources.stations import read_stations

    staging = staging_path or f"{out_path}_staging"
    planned_el, change_el, bad = _stage_load(spark, planned_paths, change_paths, staging, archive_mode)
    changes = change_rows(change_el, platform_rule)
    stations = read_stations(spark, stations_path, STATION_ORDER)
    planned = resolve_planned(planned_rows(planned_el), stations, prefix)
    movements = load_movements(planned, changes, out_path, policy, quarantine=bad, keep_unmatched=True)
    remove(spark, staging)
    return movements


def build_star(planned_elements: DataFrame, change_elements: DataFrame, stations: DataFrame,
               prefix: str = DEFAULT_PREFIX, trip_start_col=None) -> dict[str, DataFrame]:
    """E2: the star schema as six DataFrames (dimension keys are dense and
    checkpointed, so building them runs jobs; the fact stays lazy)."""
    from railflow.functions.timefmt import trip_start
    from railflow.operators import star as S
    from railflow.operators.merge import unmatched_changes

    planned = planned_rows(planned_elements)
    start = trip_start_col if trip_start_col is not None else trip_start("stop_id")
    trips = planned.withColumn("trip_start", start)
    changes = change_rows(change_elements, "star")
    tables = {
        "dim_station": S.dim_station(stations),
        "dim_train": S.dim_train(planned),
        "dim_date": S.dim_date(trips),
        "dim_time": S.dim_time(trips),
    }
    tables["fact_train_movements"] = S.build_fact(
        planned, changes, tables["dim_station"], tables["dim_train"], tables["dim_date"],
        tables["dim_time"], trip_start_col=start, prefix=prefix)
    tables["unmatched_timetable_changes"] = unmatched_changes(changes, planned)
    return tables


def etl_star(spark, planned_paths, change_paths, stations_path: str, out_dir: str,
             prefix: str = DEFAULT_PREFIX, archive_mode: str = "path",
             staging_path: str | None = None) -> dict[str, DataFrame]:
    """E2 end to end: one load of archives + station JSON merged into the
    star schema under ``out_dir`` (six tables and ``quarantine``; see
    ``incremental.read_star``)."""
    from railflow.operators.sinks import remove
    from railflow.plans.incremental import load_star
    from railflow.sources.stations import read_stations

    staging = staging_path or f"{out_dir}/staging"
    planned_el, change_el, bad = _stage_load(spark, planned_paths, change_paths, staging, archive_mode)
    tables = load_star(planned_rows(planned_el), change_rows(change_el, "star"),
                       read_stations(spark, stations_path), out_dir, prefix, quarantine=bad)
    remove(spark, staging)
    return tables
