"""Queries with SQL: Spark against DuckDB on the smallest tables."""

import pytest

from railflow.llm import queries
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    assert compare(spark, duck(SF), name, queries.QUERIES[name], queries.ORACLE_SQL[name], SF)


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
