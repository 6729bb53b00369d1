"""Plan properties the operators are designed for (static plans, AQE off)."""

import re

import pytest

from tidepool.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
MAP_ONLY = ["catalog_datasets", "schemas_from_json", "tables_from_json", "columns_from_json",
            "dependencies_from_json", "lineage_edges", "lineage_nodes", "export_tables", "export_datasets", "export_schemas", "export_dependencies",
            "group_to_list", "object_or_list", "unpivot_measures",
            "category_view", "check_digit", "soft_cast", "text_dates_arrays", "union_periods"]


def _plan(spark, key):
    df = QUERIES[key](spark, SF)
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def static(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_python_in_registered_queries(static, key):
    assert not re.search(r"\(\d+\) (ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas)",
                         _plan(static, key))


@pytest.mark.parametrize("key", MAP_ONLY)
def test_map_only_queries_do_not_shuffle(static, key):
    assert not re.search(r"Arguments: [^\n]*ENSURE_REQUIREMENTS", _plan(static, key))


def test_prefix_and_cursor_reach_the_scan(static):
    assert "StringStartsWith(event_type,p)" in _plan(static, "category_view")
    assert re.search(r"GreaterThanOrEqual\(ts,ScalarSubquery", _plan(static, "incremental"))


def test_orders_are_reduced_before_the_customer_join(static):
    plan = _plan(static, "completed_keys")
    tree = plan.split("\n\n")[0]
    # an aggregate sits between the orders scan and the join
    join_at = tree.index("Join")
    assert "HashAggregate" in tree[join_at:]


def test_columns_are_pruned(static):
    plan = _plan(static, "check_digit")
    assert "ReadSchema: struct<c_custkey:bigint>" in plan


def test_catalog_joins_are_equi_joins(static):
    from tidepool.operators import catalog, export
    from tidepool.plans.catalog_docs import part_documents
    from tidepool.plans.tables import table

    parsed = catalog.parse_documents(part_documents(table(static, SF, "part")))
    for df in (catalog.search_entries(parsed), catalog.tag_text(parsed), export.export_columns(parsed)):
        text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        assert "NestedLoop" not in text and "Cartesian" not in text
