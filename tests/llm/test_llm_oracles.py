"""Every query with a SQL form against DuckDB, on the smallest tables."""

import pytest

from sensorqc.llm import oracles, queries
from tools.check_oracle import compare, duckdb_with_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duckdb_with_tables(SF)


@pytest.mark.parametrize("name", sorted(oracles.SQL))
def test_query_matches_duckdb(spark, con, name):
    ok, n_spark, n_duck, detail = compare(queries.QUERIES[name](spark, SF), con, oracles.SQL[name])
    assert ok, f"{name}: {n_spark} vs {n_duck} rows; {detail}"


def test_ten_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
