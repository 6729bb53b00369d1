"""Build-manifest rows → per-dataset metadata documents.

Inputs are row sets (one row per manifest node / column / parent entry);
the document for each dataset is assembled with grouped aggregations whose
groups are bounded by one project's size, then rendered with ``to_json``
(NULL fields are left out, as in the published documents).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def schema_name(custom: Column, fqn: Column, target: Column) -> Column:
    """Schema of a model: trimmed custom name, else the second fqn part when
    the fqn has more than two parts, else the target schema."""
    return F.when(custom.isNotNull(), F.trim(custom)).when(F.size(fqn) > 2, F.get(fqn, 1)).otherwise(target)


def model_rows(nodes: DataFrame) -> DataFrame:
    """Manifest nodes → publishable model rows of their own dataset.

    nodes(unique_id, resource_type, fqn, schema, name, description,
    materialized, compiled_code, meta map<string,string>). Only models
    whose fqn starts with their dataset (``model.<ds>.…``) are kept. A
    ``position`` (place in the manifest) is passed through."""
    ds = F.get(F.split("unique_id", r"\."), 1)
    meta = F.col("meta")
    return nodes.where(
        (F.col("resource_type") == "model") & (F.get(F.col("fqn"), 0) == ds)
    ).select(
        ds.alias("datasource"),
        F.col("schema").alias("schema_name"),
        "unique_id",
        "name",
        F.coalesce(meta["title"], F.lit("")).alias("title"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.coalesce(F.from_json(meta["tags"], "array<string>"), F.array().cast("array<string>")).alias("tags"),
        F.coalesce(meta["license"], F.lit("")).alias("license"),
        F.coalesce(meta["license_url"], F.lit("")).alias("license_url"),
        F.coalesce(meta["source_url"], F.lit("")).alias("source_url"),
        F.coalesce(meta["published"].try_cast("boolean"), F.lit(False)).alias("published"),
        "materialized",
        F.nullif(F.trim("compiled_code"), F.lit("")).alias("sql"),
        *[c for c in ("position",) if c in nodes.columns],
    )


def _place(df: DataFrame, name: str) -> Column:
    """A row's place in the manifest; by name where the rows carry none."""
    return F.col("position" if "position" in df.columns else name)


def _ordered_map(place: Column, key: str, value: Column) -> Column:
    """Aggregate: the group's entries as a map, in the order of their places."""
    entries = F.collect_list(F.struct(F.struct(place.alias("at"), F.col(key).alias("key")).alias("place"), value.alias("value")))
    # values may hold maps, which cannot be compared: only the places are
    by_place = lambda a, b: F.when(a["place"] < b["place"], -1).when(a["place"] > b["place"], 1).otherwise(0)
    return F.map_from_entries(F.transform(F.array_sort(entries, by_place), lambda e: F.struct(e["place"]["key"], e["value"])))


def build_documents(
    configs: DataFrame,
    models: DataFrame,
    columns: DataFrame,
    parent_map: DataFrame,
    nodes: DataFrame,
) -> DataFrame:
    """One JSON document per dataset: config fields, schemas (declared ones
    first, in config order, then undeclared schemas in the order of their first
    model), tables with columns, lineage, dependencies.

    Tables, parents and nodes come in the order of their ``position`` (place in
    the manifest), columns too; rows without that column come by name. Places are
    carried through the grouping, as rows of a table have no order of their own.

    configs(datasource, title, description, cover, tags, ducklake_url,
    schemas array<struct<name,title>>, dependencies, readme);
    models from :func:`model_rows`; columns(unique_id, position, name,
    title, description, data_type, nullable); parent_map(datasource, child,
    parents); nodes(datasource, name, fqn, resource_type, materialized, meta).
    """
    col_lists = columns.groupBy("unique_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("position", "name", "title", "description", "data_type", "nullable"))),
            lambda c: F.struct(c["name"].alias("name"), c["title"].alias("title"),
                               c["description"].alias("description"), c["data_type"].alias("data_type"),
                               c["nullable"].alias("nullable")),
        ).alias("columns")
    )
    tables = models.join(col_lists, "unique_id", "left").select(
        "datasource", "schema_name", _place(models, "name").alias("_at"),
        F.struct(
            "name", "title", "description", "tags", "license", "license_url", "source_url",
            "published", "materialized",
            F.coalesce("columns", F.array().cast(col_lists.schema["columns"].dataType)).alias("columns"),
            "sql",
        ).alias("t"),
    )
    by_schema = tables.groupBy("datasource", "schema_name").agg(
        F.array_sort(F.collect_list(F.struct("_at", F.col("t.name").alias("_n"), "t"))).alias("_ts"),
        F.min("_at").alias("_first"),
    ).select("datasource", "schema_name", F.transform("_ts", lambda x: x["t"]).alias("tables"), "_first")
    declared = configs.select("datasource", F.posexplode("schemas").alias("_pos", "_s")).select(
        "datasource", F.col("_s.name").alias("schema_name"), F.col("_s.title").alias("title"), "_pos"
    )
    merged = declared.join(by_schema, ["datasource", "schema_name"], "full").select(
        "datasource", "schema_name",
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("tables", F.array().cast(by_schema.schema["tables"].dataType)).alias("tables"),
        F.struct(F.coalesce("_pos", F.lit(1 << 30)).alias("_pos"), "_first").alias("_pos"),
    )
    schemas = merged.groupBy("datasource").agg(
        _ordered_map(F.col("_pos"), "schema_name", F.struct("title", "tables")).alias("_schema_map")
    )
    pmap = parent_map.groupBy("datasource").agg(
        _ordered_map(_place(parent_map, "child"), "child", F.col("parents")).alias("parent_map")
    )
    node = F.struct("fqn", "resource_type", F.struct("materialized").alias("config"), "meta")
    nmap = nodes.groupBy("datasource").agg(_ordered_map(_place(nodes, "name"), "name", node).alias("nodes"))
    doc = (
        configs.drop("schemas").join(schemas, "datasource", "left")
        .join(pmap, "datasource", "left")
        .join(nmap, "datasource", "left")
    )
    return doc.select(
        "datasource",
        F.to_json(
            F.struct(
                "title", "description", F.coalesce("cover", F.lit("")).alias("cover"), "tags",
                "ducklake_url", F.col("_schema_map").alias("schemas"),
                F.struct(
                    F.coalesce("parent_map", F.create_map().cast(pmap.schema["parent_map"].dataType)).alias("parent_map"),
                    F.coalesce("nodes", F.create_map().cast(nmap.schema["nodes"].dataType)).alias("nodes"),
                ).alias("lineage"),
                "dependencies", "readme",
            )
        ).alias("document"),
        F.aggregate(
            F.map_values("_schema_map"), F.lit(0), lambda acc, s: acc + F.size(s["tables"])
        ).alias("total_tables"),
    )


def with_stub_documents(docs: DataFrame, configs: DataFrame) -> DataFrame:
    """Metadata documents plus a stub for every configured dataset that has
    none yet: config title, description, tags and catalog URL, its declared
    schemas with no tables, and empty lineage.

    ``docs`` has the document columns (JSON parts as text); ``configs``
    is a table (datasource, title, description, tags array, ducklake_url,
    schemas array of (name, title))."""
    missing = configs.join(docs.select("datasource"), "datasource", "left_anti")
    stubs = missing.selectExpr(
        "datasource",
        "title",
        "description",
        "CAST(NULL AS STRING) AS cover",
        "to_json(coalesce(tags, array())) AS tags",
        "ducklake_url",
        "to_json(map_from_entries(transform(coalesce(schemas, array()), "
        "s -> struct(s.name, named_struct('title', coalesce(s.title, ''), 'tables', array()))))) AS schemas",
        "CAST(NULL AS STRING) AS dependencies",
        "'{\"parent_map\":{},\"nodes\":{}}' AS lineage",
        "CAST(NULL AS STRING) AS readme",
    )
    return docs.unionByName(stubs.select(*docs.columns))
