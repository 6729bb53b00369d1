import json

from pyspark.sql import functions as F

from tidepool.operators import catalog, export
from tidepool.sources.documents import read_metadata_documents, registry_paths, stale_sources


def _doc(**kw):
    base = {
        "title": "T", "description": "D", "cover": "", "tags": ["a"], "ducklake_url": "u",
        "schemas": {}, "lineage": {"parent_map": {}, "nodes": {}},
    }
    base.update(kw)
    return base


def _write(tmp, docs):
    for name, doc in docs.items():
        d = tmp / name
        d.mkdir()
        (d / "metadata.json").write_text(json.dumps(doc, ensure_ascii=False, indent=2))


DOCS = {
    "stats": _doc(
        schemas={
            "main": {"title": "Main", "tables": [
                {"name": "pop", "title": "Population", "description": "people", "tags": ["x", "y"],
                 "license": "CC", "license_url": "", "source_url": "s", "published": True,
                 "materialized": "table",
                 "columns": [{"name": "area_code", "title": "Area", "description": "code",
                              "data_type": "VARCHAR", "nullable": False},
                             {"name": "n", "description": "count", "data_type": "BIGINT"}]},
                {"name": "empty_cols", "title": "E", "description": "", "tags": [], "license": "",
                 "license_url": "", "source_url": "", "materialized": "view", "columns": []},
            ]},
            "stg": {"title": "Staging", "tables": [
                {"name": "pop", "title": "Pop stage", "description": "d2", "tags": ["z"],
                 "license": "", "license_url": "", "source_url": "", "materialized": "view",
                 "columns": "not-an-array"}]},
            "odd": {"title": "not a list", "tables": {"name": "x"}},
            "with.dot": {"title": "Dotted", "tables": []},
        },
        dependencies=[{"alias": "dep", "ducklake_url": "https://x"}],
        lineage={"parent_map": {"pop": ["raw_pop"], "raw_pop": []},
                 "nodes": {"pop": {"fqn": ["stats", "main", "pop"], "resource_type": "model",
                                   "config": {"materialized": "table"}, "meta": {"k": 1}}}},
    ),
    "bare": {"title": "Bare", "description": "no lineage", "tags": [], "ducklake_url": "v",
             "schemas": {}},
}


def test_flatten_documents(spark, tmp):
    _write(tmp, DOCS)
    docs = read_metadata_documents(spark, [str(tmp / n / "metadata.json") for n in DOCS])
    parsed = catalog.parse_documents(docs)
    ds = {r.datasource: r for r in catalog.datasets(parsed).collect()}
    assert set(ds) == {"stats", "bare"}
    assert ds["stats"].tags_json == '["a"]'  # compact whatever the file layout

    schemas = {(r.datasource, r.schema_name): r.title for r in catalog.schemas(parsed).collect()}
    assert schemas[("stats", "with.dot")] == "Dotted"  # dotted keys survive
    assert len(schemas) == 4

    tables = catalog.tables(parsed).collect()
    assert sorted((t.schema_name, t.node_index, t.name) for t in tables) == [
        ("main", 1, "pop"), ("main", 2, "empty_cols"), ("stg", 1, "pop")]
    pub = {(t.schema_name, t.name): t.is_published for t in tables}
    assert pub[("main", "pop")] is True and pub[("main", "empty_cols")] is False

    cols = catalog.columns(parsed).collect()
    assert [(c.column_name, c.column_index, c.title, c.nullable) for c in sorted(cols, key=lambda c: c.column_index)] == [
        ("area_code", 1, "Area", False), ("n", 2, "", True)]

    deps = catalog.dependencies(parsed).collect()
    assert [(d.datasource, d.alias) for d in deps] == [("stats", "dep")]
    edges = sorted(tuple(r) for r in catalog.lineage_edges(parsed).collect())
    assert edges == [("stats", "pop", "raw_pop")]
    nodes = catalog.lineage_nodes(parsed).collect()
    assert [(n.name, n.fqn_json, n.meta_json) for n in nodes] == [("pop", '["stats","main","pop"]', '{"k":1}')]


def test_search_entries_fan_out_and_tags(spark, tmp):
    _write(tmp, DOCS)
    parsed = catalog.parse_documents(read_metadata_documents(spark, [str(tmp / n / "metadata.json") for n in DOCS]))
    t, c = catalog.tables(parsed), catalog.columns(parsed)
    tags = {r.name: r.tags_text for r in catalog.table_tag_text(t).collect()}
    assert tags == {r.name: r.tags_text for r in catalog.tag_text(parsed).collect()}
    assert tags["pop"] == "x y z"  # both schemas, ordered by schema then index
    entries = catalog.search_entries_joined(t, c).collect()
    local = catalog.search_entries(parsed).collect()
    assert sorted(map(tuple, local), key=str) == sorted(map(tuple, entries), key=str)
    col_rows = [e for e in entries if e.entry_type == "column"]
    # same table name in two schemas: each column appears once per schema
    assert len(col_rows) == 4
    assert {e.href for e in col_rows} == {"/datasets/stats/main/pop", "/datasets/stats/stg/pop"}
    table_rows = [e for e in entries if e.entry_type == "table"]
    assert len(table_rows) == 3
    assert any(e.search_text == "pop Population people x y z" for e in table_rows)
    exported = export.export_columns_joined(t, c).collect()
    assert sorted(map(tuple, export.export_columns(parsed).collect())) == sorted(map(tuple, exported))
    assert {e.id for e in exported} == {"stats/main/pop/area_code", "stats/main/pop/n",
                                        "stats/stg/pop/area_code", "stats/stg/pop/n"}
    assert all(e.statement.startswith("INSERT OR REPLACE INTO catalog_columns") for e in exported)


def test_registry_and_stale_sources(spark, tmp):
    _write(tmp, DOCS)
    paths = registry_paths(["stats", "bare"], str(tmp))
    docs = read_metadata_documents(spark, paths)
    assert sorted(r.datasource for r in docs.collect()) == ["bare", "stats"]
    present = spark.createDataFrame([("raw_stats.sql",), ("raw_old.sql",), ("_schema.yml",)], "name string")
    expected = spark.createDataFrame([("raw_stats.sql",), ("raw_bare.sql",), ("_schema.yml",)], "name string")
    assert [r.name for r in stale_sources(present, expected).collect()] == ["raw_old.sql"]


def test_publish_writes_every_mart_from_one_parse(spark, tmp):
    (tmp / "docs").mkdir()
    _write(tmp / "docs", DOCS)
    docs = read_metadata_documents(spark, [str(tmp / "docs" / n / "metadata.json") for n in DOCS])
    paths = catalog.publish(docs, str(tmp / "catalog"))
    assert set(paths) == set(catalog.MARTS)
    counts = {k: spark.read.parquet(p).count() for k, p in paths.items()}
    parsed = catalog.parse_documents(docs)
    assert counts["mart_tables"] == catalog.tables(parsed).count() == 3
    assert counts["mart_columns"] == 2 and counts["mart_search_entries"] == 7
    assert counts["mart_lineage_edges"] == 1 and counts["mart_datasets"] == 2


def test_one_datasource_over_two_documents(spark):
    """Tables of one name in two documents of a datasource join across the documents."""
    col = {"name": "c", "data_type": "INT"}
    docs = [
        ("ds", json.dumps({"main": {"tables": [{"name": "t", "tags": ["x"], "columns": [col]}]}})),
        ("ds", json.dumps({"extra": {"tables": [{"name": "t", "tags": ["y"]}]}})),
    ]
    parsed = catalog.parse_documents(_text_documents(spark, docs))
    entries = catalog.search_entries(parsed).collect()
    assert sorted((e.entry_type, e.href) for e in entries) == [
        ("column", "/datasets/ds/extra/t"), ("column", "/datasets/ds/main/t"),
        ("table", "/datasets/ds/extra/t"), ("table", "/datasets/ds/main/t"),
    ]
    assert [r.tags_text for r in catalog.tag_text(parsed).collect()] == ["y x"]
    assert {r.id for r in export.export_columns(parsed).collect()} == {"ds/main/t/c", "ds/extra/t/c"}


def test_document_with_many_tables(spark):
    tables = [{"name": f"t{k}", "tags": [f"g{k}"], "columns": [{"name": "c"}]} for k in range(5000)]
    parsed = catalog.parse_documents(_text_documents(spark, [("big", json.dumps({"main": {"tables": tables}}))]))
    entries = catalog.search_entries(parsed)
    assert entries.count() == 10_000
    assert entries.where("entry_type = 'column' AND schema_name IS NULL").count() == 0
    assert export.export_columns(parsed).count() == 5000


def _text_documents(spark, docs):
    text = ("title", "description", "cover", "tags", "ducklake_url", "dependencies", "lineage", "readme")
    df = spark.createDataFrame(docs, "datasource string, schemas string")
    return df.withColumns({c: F.lit(None).cast("string") for c in text})


def test_documents_from_a_path_mapping(spark, tmp):
    (tmp / "flat").mkdir()
    for name, doc in DOCS.items():
        (tmp / "flat" / f"{name}-copy.json").write_text(json.dumps(doc, ensure_ascii=False))
    docs = read_metadata_documents(
        spark, {f"ds_{name}": str(tmp / "flat" / f"{name}-copy.json") for name in DOCS}
    )
    assert sorted(r.datasource for r in docs.collect()) == ["ds_bare", "ds_stats"]
    parsed = catalog.parse_documents(docs)
    assert catalog.tables(parsed).where("datasource = 'ds_stats'").count() == 3
