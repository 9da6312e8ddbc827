"""Every registered query against its DuckDB oracle on the smallest TESTDATA."""

import pytest

import __spark_entry__ as entry
from tools.oracle_check import compare, duckdb_views

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "id" in df.columns
