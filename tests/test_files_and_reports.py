"""Inferred CSV types, listings, documents by file, manifest order, survey report, copies, arcs."""

import gzip
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.operators import information_schema, load, metadata, survey
from tidepool.sources.csv import infer_types, read_csv_named
from tidepool.sources.documents import document_files, read_registered
from tidepool.sources.files import write_files
from tidepool.sources.listing import list_files
from tidepool.sources.topojson import decode_topologies


def _types(df):
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def test_the_last_row_alone_widens_a_column(spark, tmp):
    lines = ["code,whole,wide,mixed,day,late,none,big,exp"]
    lines += [f"{k:05d},{k},{k},{k},2024-01-{k % 28 + 1:02d},2024-01-01,,9223372036854775807,{k}" for k in range(400)]
    lines += ["00400,-400,1.5,x,,2024-13-01,,9223372036854775808,1e3"]
    (tmp / "a.csv").write_text("\n".join(lines) + "\n")
    df = read_csv_named(spark, str(tmp / "a.csv"), {"code": "string"}, default="infer")
    assert _types(df) == {"code": "string", "whole": "bigint", "wide": "double", "mixed": "string", "day": "date", "late": "string",
                          "none": "string", "big": "double", "exp": "double"}
    last = df.where("code = '00400'").first()
    assert (last.whole, last.wide, last.mixed, last.day, last.exp) == (-400, 1.5, "x", None, 1000.0)
    assert df.count() == 401


@pytest.mark.parametrize(("values", "kind"), [
    ([], "string"), ([None, ""], "string"), (["1", " 2 "], "bigint"), (["1", "2.0"], "double"), (["2024-02-29", None], "date"),
    (["2024-02-30"], "string"), (["2024-01-01", "7"], "string"), (["+5", "-6"], "bigint"), (["1d"], "string"), (["NaN"], "string"),
])
def test_type_lattice(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    assert infer_types(df, ["x"]) == {"x": kind}


def test_types_are_joined_over_files_with_different_headers(spark, tmp):
    (tmp / "1.csv").write_text("a,b\n1,2\n")
    (tmp / "2.csv").write_text("b,c\n3.5,x\n")
    (tmp / "3.csv").write_text("")
    df = read_csv_named(spark, str(tmp), default="infer")
    assert _types(df) == {"a": "bigint", "b": "double", "c": "string"}
    assert sorted(map(tuple, df.collect()), key=str) == [(1, 2.0, None), (None, 3.5, "x")]


def test_headers_of_packed_and_encoded_files(spark, tmp):
    (tmp / "a.csv.gz").write_bytes(gzip.compress("年,人口\n2024,5\n".encode("shift_jis")))
    (tmp / "b.csv").write_bytes("年,人口\r\n2025,6\r\n".encode("shift_jis"))
    df = read_csv_named(spark, str(tmp), default="infer", encoding="shift_jis")
    assert sorted(map(tuple, df.collect())) == [(2024, 5), (2025, 6)]


def test_one_scan_where_headers_agree(spark, tmp):
    spark.range(1000).selectExpr("id AS a", "id AS b").repartition(6).write.option("header", True).csv(str(tmp / "c"))
    df = read_csv_named(spark, str(tmp / "c"))
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert plan.split("\n\n")[0].count("Scan csv") == 1 and df.count() == 1000


def test_listing_by_level(spark, tmp):
    for path, size in {"a/1.bin": 3, "a/b/c/2.bin": 5, "d e/日 %20#.bin": 0, "a/_hidden/3.bin": 1, ".x/4": 1, "top.txt": 2}.items():
        (tmp / "r" / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp / "r" / path).write_bytes(b"x" * size)
    got = {r.path: r["size"] for r in list_files(spark, str(tmp / "r")).collect()}
    assert got == {"a/1.bin": 3, "a/b/c/2.bin": 5, "d e/日 %20#.bin": 0, "top.txt": 2}
    assert [r.path for r in list_files(spark, "file:" + str(tmp / "r"), "*.txt").collect()] == ["top.txt"]
    assert list_files(spark, str(tmp / "missing")).count() == 0


def test_registered_documents(spark, tmp):
    docs = spark.createDataFrame(
        [("a b+c%20", "T", None, None, '["x"]', "u", "{}", None, None, "r"), ("extra", "E", None, None, None, "u", None, None, None, None)],
        "datasource string, title string, description string, cover string, tags string, ducklake_url string, schemas string, "
        "dependencies string, lineage string, readme string",
    )
    write_files(document_files(docs), str(tmp / "m"))
    registry = spark.createDataFrame([("a b+c%20", 1), ("none", 2)], "datasource string, rank int")
    got = {r.datasource: (r["rank"], r.has_document, r.title, r.tags, r.schemas) for r in read_registered(spark, registry, str(tmp / "m")).collect()}
    assert got == {"a b+c%20": (1, True, "T", '["x"]', "{}"), "none": (2, False, None, None, None)}


def test_documents_keep_the_order_of_the_manifest(spark):
    models = spark.createDataFrame(
        [("d", s, f"model.d.{n}", n, "", "", [], "", "", "", False, "view", None, p)
         for p, (s, n) in enumerate([("late", "z"), ("main", "m2"), ("main", "a1"), ("early", "k"), ("late", "b")])],
        "datasource string, schema_name string, unique_id string, name string, title string, description string, tags array<string>, "
        "license string, license_url string, source_url string, published boolean, materialized string, sql string, position int",
    )
    columns = spark.createDataFrame([("model.d.z", 2, "a"), ("model.d.z", 1, "b")], "unique_id string, position int, name string").selectExpr(
        "*", "'' AS title", "'' AS description", "'INT' AS data_type", "true AS nullable")
    configs = spark.createDataFrame(
        [("d", "T", "", None, [], "u", [{"name": "main", "title": "M"}], None, None)],
        "datasource string, title string, description string, cover string, tags array<string>, ducklake_url string, "
        "schemas array<struct<name:string,title:string>>, dependencies array<struct<alias:string,ducklake_url:string>>, readme string",
    )
    names = ["z", "m2", "a1", "k", "b"]
    parents = spark.createDataFrame([("d", n, [], p) for p, n in enumerate(names)], "datasource string, child string, parents array<string>, position int")
    nodes = spark.createDataFrame([("d", n, [], "model", "view", {}, p) for p, n in enumerate(names)],
                                  "datasource string, name string, fqn array<string>, resource_type string, materialized string, meta map<string,string>, position int")
    rows = metadata.build_documents(configs, models.repartition(4), columns.repartition(3), parents.repartition(4), nodes.repartition(4)).collect()
    doc = json.loads(rows[0].document)
    assert {s: [t["name"] for t in v["tables"]] for s, v in doc["schemas"].items()} == {"main": ["m2", "a1"], "late": ["z", "b"], "early": ["k"]}
    assert list(doc["schemas"]) == ["main", "late", "early"]
    assert list(doc["lineage"]["parent_map"]) == names and list(doc["lineage"]["nodes"]) == names
    assert [c["name"] for c in doc["schemas"]["late"]["tables"][0]["columns"]] == ["b", "a"]


def _entries(spark, entries):
    return spark.createDataFrame([(i, json.dumps(e, ensure_ascii=False)) for i, e in enumerate(entries)], "position int, entry string")


def test_survey_report(spark):
    entries = [
        {"@id": "1", "TITLE": "小地域 a", "STAT_NAME": {"$": "国勢調査", "@code": "00200521"}, "SURVEY_DATE": "2015"},
        {"@id": "2", "TITLE": {"$": "町丁 b"}, "STAT_NAME": "国勢調査", "SURVEY_DATE": "2020"},
        {"@id": "3", "TITLE": "字等 c", "STAT_NAME": "国勢調査", "SURVEY_DATE": "2020"},
        {"@id": "4", "TITLE": "メッシュ 小地域", "STAT_NAME": "国勢調査", "SURVEY_DATE": "2021"},
        {"@id": "5", "TITLE": "other", "STAT_NAME": "x"},
        {"@id": "6", "TITLE": "t", "STATISTICS_NAME": "小地域統計", "STAT_NAME": "経済"},
    ]
    rows = survey.survey_report(_entries(spark, entries).repartition(3), "entry", "position").collect()
    classes = {r.category: r.n_tables for r in rows if r.section == "class"}
    assert classes == {"small_area": 4, "mesh": 1, "unknown": 1}
    surveys = {r.survey: r for r in rows if r.section == "survey"}
    assert set(surveys) == {"国勢調査", "経済"}
    census = surveys["国勢調査"]
    assert (census.n_tables, census.stat_code, census.dates, census.latest_id, census.latest_title) == (3, "00200521", "2015,2020", "2", "町丁 b")
    assert (surveys["経済"].dates, surveys["経済"].latest_id) == ("", "6")


def test_survey_report_falls_back_to_the_unknown_class(spark):
    rows = survey.survey_report(_entries(spark, [{"@id": "1", "TITLE": "x", "STAT_NAME": "s"}]), "entry", "position").collect()
    assert sorted((r.section, r.category, r.survey, r.n_tables) for r in rows) == [("class", "unknown", None, 1), ("survey", "unknown", "s", 1)]
    assert survey.survey_report(_entries(spark, []), "entry", "position").count() == 0


def test_copied_views_mean_the_copied_tables(spark):
    spark.sql("DROP DATABASE IF EXISTS cp_a CASCADE")
    spark.sql("DROP DATABASE IF EXISTS cp_b CASCADE")
    spark.sql("CREATE DATABASE cp_a")
    spark.range(5).write.saveAsTable("cp_a.t")
    spark.catalog.setCurrentDatabase("cp_a")
    spark.sql("CREATE VIEW z_first AS SELECT id FROM t WHERE id > 1")
    spark.sql("CREATE VIEW a_second AS SELECT count(*) AS n FROM z_first")  # reads a view whose name comes later
    spark.catalog.setCurrentDatabase("default")
    assert sorted(load.copy_namespace(spark, "cp_a", "cp_b")) == ["a_second", "t", "z_first"]
    spark.range(5, 9).write.mode("append").saveAsTable("cp_a.t")
    assert spark.table("cp_b.a_second").first().n == 3
    load.copy_namespace(spark, "cp_a", "cp_b")  # emptied and filled, not filled twice
    assert spark.table("cp_b.a_second").first().n == 7 and spark.table("cp_b.t").count() == 9
    spark.sql("DROP DATABASE cp_a CASCADE")
    assert spark.table("cp_b.a_second").first().n == 7
    tables, views, columns = information_schema.session_relations(spark, ["CP_B"])
    assert [r.table_name for r in tables.collect()] == ["t"] and {r.table_name for r in views.collect()} == {"a_second", "z_first"}
    assert {(r.table_name, r.column_name, r.column_index, r.data_type) for r in columns.collect()} == {
        ("t", "id", 1, "BIGINT"), ("z_first", "id", 1, "BIGINT"), ("a_second", "n", 1, "BIGINT")}
    spark.sql("DROP DATABASE cp_b CASCADE")


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 200_000])
def test_arcs_of_any_length(spark, n):
    rng = np.random.default_rng(n)
    deltas = rng.integers(-5, 6, (n, 2))
    topology = {"type": "Topology", "transform": {"scale": [0.5, 2], "translate": [10, -3]}, "arcs": [deltas.tolist()],
                "objects": {"o": {"type": "LineString", "arcs": [0]}}}
    df = spark.createDataFrame([("s", json.dumps(topology))], "source string, value string")
    got = json.loads(decode_topologies(df).select("geometry").first()[0])["coordinates"]
    assert np.allclose(np.array(got), np.cumsum(deltas, 0) * [0.5, 2] + [10, -3])


def test_published_orders(spark):
    """Reports that are sorted come sorted (the oracle compares rows only)."""
    from tidepool.plans.registry import QUERIES

    sf = "/root/testdata/sf0.001"
    dates = [r.date for r in QUERIES["articles"](spark, sf).collect()]
    assert dates == sorted(dates, reverse=True)
    groups = [(-r.n_items, r.o_orderpriority) for r in QUERIES["latest_per_group"](spark, sf).collect()]
    assert groups == sorted(groups) and len(groups) == 5
