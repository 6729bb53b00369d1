"""Build-manifest extraction: own-project lineage, column types, models.

Manifest nodes and parent-map entries arrive as rows (one per node id);
the dataset a node belongs to is read from its id (``model.<ds>.<name>``),
so all datasets are extracted in one pass with equi-joins only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _own_prefix(ds: F.Column) -> F.Column:
    return F.concat(F.lit("model."), ds, F.lit("."))


def extract_lineage(parent_map: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Own-project lineage per dataset.

    parent_map(child, parents array) with full ids; nodes(unique_id, fqn,
    resource_type, materialized, meta). Keeps children ``model.<ds>.*`` and
    their parents with the same prefix, both shortened to the name; nodes
    are children ∪ kept parents, taken from the manifest when present and
    given defaults (``[]``, ``model``, ``view``, ``{}``) otherwise.
    Returns (edges(datasource, child, parent), nodes(datasource, name, ...)).
    """
    own = parent_map.where(F.col("child").startswith("model.")).select(
        F.get(F.split("child", r"\."), 1).alias("datasource"), "child", "parents"
    )
    start = F.length("datasource") + F.lit(8)  # after "model.<ds>."
    own = own.select(
        "datasource",
        F.substr("child", start).alias("child"),
        F.transform(
            F.filter("parents", lambda p: p.startswith(_own_prefix(F.col("datasource")))),
            lambda p: F.substr(p, start),
        ).alias("parents"),
    )
    edges = own.select("datasource", "child", F.explode("parents").alias("parent"))
    keys = own.select("datasource", F.col("child").alias("name")).unionByName(
        edges.select("datasource", F.col("parent").alias("name"))
    ).distinct()
    full = F.concat(_own_prefix(F.col("datasource")), F.col("name"))
    info = nodes.select(
        F.col("unique_id").alias("_uid"), "fqn", "resource_type", "materialized", "meta"
    )
    resolved = keys.withColumn("_uid", full).join(info, "_uid", "left").select(
        "datasource",
        "name",
        F.coalesce(F.col("fqn"), F.array().cast("array<string>")).alias("fqn"),
        F.coalesce("resource_type", F.lit("model")).alias("resource_type"),
        F.coalesce("materialized", F.lit("view")).alias("materialized"),
        F.coalesce(F.col("meta"), F.create_map().cast("map<string,string>")).alias("meta"),
    )
    return edges, resolved


def resolve_column_types(manifest_columns: DataFrame, catalog_columns: DataFrame) -> DataFrame:
    """Column metadata with the physical type preferred over the declared one.

    manifest_columns(node_id, column_name, data_type, title, description,
    constraints array<struct<type>>); catalog_columns(node_id, column_name,
    type). Type = catalog type when non-empty, else declared, else ''.
    Nullable unless a ``not_null`` constraint exists. Descriptions are
    trimmed and empty ones become NULL.
    """
    cat = catalog_columns.select("node_id", "column_name", F.col("type").alias("_catalog_type"))
    m = manifest_columns.join(cat, ["node_id", "column_name"], "left")
    return m.select(
        "node_id",
        "column_name",
        F.coalesce(F.nullif("_catalog_type", F.lit("")), F.col("data_type"), F.lit("")).alias("data_type"),
        (~F.exists("constraints", lambda c: c["type"] == "not_null")).alias("nullable"),
        F.coalesce("title", F.lit("")).alias("title"),
        F.nullif(F.trim("description"), F.lit("")).alias("description"),
    )
