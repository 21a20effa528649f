"""Every registered query against its DuckDB SQL on the smallest fixture."""

import pytest

import __spark_entry__ as E
from sensorqc.plans import registry
from tools.check_oracle import compare, duckdb_with_tables

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_with_tables(SF)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_duckdb(spark, con, name):
    ok, n_spark, n_duck, detail = compare(registry.queries()[name](spark, SF), con, SQL[name])
    assert ok, f"{name}: {n_spark} vs {n_duck} rows; {detail}"
