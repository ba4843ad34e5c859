"""Every registered query against its DuckDB oracle on the smallest driver
tables (the driver's correctness gate, run locally at sf0.001)."""

import pytest

import __spark_entry__ as entry
from railflow.plans import catalog
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    sql = entry.oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle"
    assert compare(spark, con, name, entry.queries()[name], sql, SF)


def test_entry_smoke(spark):
    from railflow.schemas import MOVEMENT_COLUMNS
    df = entry.entry(spark)
    assert df.columns == MOVEMENT_COLUMNS
    assert df.count() > 0


@pytest.mark.parametrize("name", ["snapshot_parse", "parse_stop_id", "xml_planned", "edge_connections",
                                  "merge_movements", "earliest_arrival"])
def test_results_do_not_depend_on_session_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")   # +05:30, not whole hours
        assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
