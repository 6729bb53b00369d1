"""Registered queries equal their DuckDB SQL where there is one."""

import duckdb
import pytest

import __spark_entry__ as entry
from tidepool.llm.queries import ORACLE, QUERIES
from tools.oracle_check import compare, register_tables

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_equals_sql(spark, key):
    con = duckdb.connect()
    register_tables(con, SF)
    assert compare(QUERIES[key](spark, SF), con, ORACLE[key]) == []
