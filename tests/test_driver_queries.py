"""Every registered query equals its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tidepool.plans.oracle import ORACLE
from tidepool.plans.registry import QUERIES
from tools.oracle_check import compare, register_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    register_tables(c, SF)
    return c


def test_every_query_has_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    assert compare(df, con, entry.oracle_sql()[key]) == []


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "search_text" in df.columns
