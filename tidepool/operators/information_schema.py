"""Column catalog across attached databases: (tables ∪ views) ⋈ columns.

Relations from every attached database are listed, except the lake
engine's metadata databases and the built-in ones; the selected schemas
are matched case-insensitively.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Databases never reported. A LIKE pattern: each underscore stands for any character.
METADATA_DB_PATTERN = "__ducklake_metadata%"
SYSTEM_DATABASES = ("system", "temp", "memory")

KEYS = ["database_name", "schema_name", "table_name"]


def relation_columns(
    tables: DataFrame,
    views: DataFrame,
    columns: DataFrame,
    schemas: Sequence[str],
) -> DataFrame:
    """tables/views(database_name, schema_name, table_name, comment);
    columns(database_name, schema_name, table_name, column_name,
    column_index, data_type, comment)."""

    def relations(df: DataFrame, kind: str) -> DataFrame:
        return df.select(*KEYS, F.lit(kind).alias("table_type"), F.col("comment").alias("table_comment"))

    rel = relations(tables, "BASE TABLE").unionByName(relations(views, "VIEW"))
    rel = rel.where(
        ~F.col("database_name").like(METADATA_DB_PATTERN)
        & ~F.col("database_name").isin(*SYSTEM_DATABASES)
        & F.upper("schema_name").isin(*[s.upper() for s in schemas])
    )
    cols = columns.where(F.upper("schema_name").isin(*[s.upper() for s in schemas])).select(
        *KEYS, "column_name", "column_index", F.col("data_type").alias("column_type"),
        F.col("comment").alias("column_comment"),
    )
    return (
        rel.join(cols, KEYS)
        .select(
            F.col("database_name").alias("table_database"),
            F.col("schema_name").alias("table_schema"),
            "table_name", "table_type", "table_comment", "column_name", "column_index",
            "column_type", "column_comment",
            F.lit(None).cast("string").alias("table_owner"),
        )
        .orderBy("table_database", "table_schema", "table_name", "column_index")
    )


_RELATION = "database_name string, schema_name string, table_name string, comment string"
_COLUMN = (
    "database_name string, schema_name string, table_name string, column_name string, "
    "column_index int, data_type string, comment string"
)


def session_relations(
    spark: SparkSession, schemas: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tables, views, columns) of the session's current catalog, as
    :func:`relation_columns` takes them; of the given schemas, or of all.

    A catalog's metadata lives with the driver's catalog client, which no
    task can reach, so names and schemas are read there; no data is."""
    catalog = spark.catalog.currentCatalog()
    wanted = {s.upper() for s in schemas} if schemas is not None else None
    tables, views, columns = [], [], []
    for db in spark.catalog.listDatabases():
        if wanted is not None and db.name.upper() not in wanted:
            continue
        for t in spark.catalog.listTables(db.name):
            if t.isTemporary:
                continue
            key = (catalog, db.name, t.name)
            (views if t.tableType == "VIEW" else tables).append((*key, t.description))
            for i, f in enumerate(spark.table(f"`{db.name}`.`{t.name}`").schema.fields, 1):
                columns.append((*key, f.name, i, f.dataType.simpleString().upper(), f.metadata.get("comment")))
    return (
        spark.createDataFrame(tables, _RELATION),
        spark.createDataFrame(views, _RELATION),
        spark.createDataFrame(columns, _COLUMN),
    )
