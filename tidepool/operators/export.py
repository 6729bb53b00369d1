"""Export of catalog marts as keyed rows and SQL statements, and batched
pushes of such rows to an external sink.

Rows are rendered as ``INSERT OR REPLACE`` statements with the publishing
conventions: NULL → ``NULL``, text quoted with ``'`` doubled, booleans as
``1``/``0``, JSON lists with ``", "`` separators.

:func:`script` puts the statements of a full refresh into one order: every
table is emptied first, then datasets, dependencies, schemas, tables and columns
follow, each in its own order. Run in that order they leave the target with
just the exported rows, whatever it held.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.text import path_key, sql_bool, sql_json, sql_value
from tidepool.operators import catalog
from tidepool.operators.ordering import staged, with_row_numbers
from tidepool.sources.files import write_files

# Fixed value: rows per pushed batch, as in the catalog export.
PUSH_BATCH_ROWS = 200

# The exported tables, in the order in which they are emptied.
EXPORTED = ("catalog_datasets", "catalog_schemas", "catalog_tables", "catalog_columns", "catalog_dependencies")


def insert_statement(table: str, values: Sequence[tuple[str, Column]]) -> Column:
    """``INSERT OR REPLACE INTO t (a, b) VALUES (<lit a>, <lit b>);``"""
    names = ", ".join(n for n, _ in values)
    parts: list[Column] = [F.lit(f"INSERT OR REPLACE INTO {table} ({names}) VALUES (")]
    for i, (_, lit) in enumerate(values):
        if i:
            parts.append(F.lit(", "))
        parts.append(lit)
    parts.append(F.lit(");"))
    return F.concat(*parts)


def export_columns_joined(table_rows: DataFrame, column_rows: DataFrame) -> DataFrame:
    """Column export rows: columns ⋈ tables on (node_id, datasource).

    A node id carries no schema, so a table name present in two schemas
    yields one row per schema (kept, as published)."""
    t = table_rows.select(
        F.col("datasource").alias("_ds"), F.col("node_id").alias("_nid"),
        "schema_name", F.col("name").alias("_tname"),
    )
    c = column_rows
    j = c.join(t, (c.node_id == t._nid) & (c.datasource == t._ds))
    out = j.select(
        path_key("datasource", "schema_name", "_tname", "column_name").alias("id"),
        "datasource",
        "schema_name",
        F.col("_tname").alias("table_name"),
        "column_name",
        "title",
        F.coalesce("description", F.lit("")).alias("description"),
        "data_type",
        F.coalesce("column_index", F.lit(0)).alias("column_index"),
    )
    return _with_column_statement(out)


def _with_column_statement(out: DataFrame) -> DataFrame:
    return out.withColumn(
        "statement",
        insert_statement(
            "catalog_columns",
            [(n, sql_value(n)) for n in
             ("id", "datasource", "schema_name", "table_name", "column_name", "title",
              "description", "data_type")]
            + [("column_index", F.col("column_index").cast("string"))],
        ),
    )


def export_tables(table_rows: DataFrame, *kept: str) -> DataFrame:
    """Table export rows with id ``ds/schema/name`` and publishing defaults;
    further columns named in ``kept`` are passed through."""
    t = table_rows
    tags = F.from_json(F.col("tags_json"), "array<string>")
    out = t.select(
        path_key("datasource", "schema_name", "name").alias("id"),
        "datasource", "schema_name", "name",
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.col("materialized").alias("type"),
        "license", "license_url", "source_url", "is_published",
        tags.alias("_tags"), "sql", *kept,
    )
    return out.select(
        "id", "datasource", "schema_name", "name", "title", "description", "type",
        "is_published", *kept,
        insert_statement(
            "catalog_tables",
            [(n, sql_value(n)) for n in
             ("id", "datasource", "schema_name", "name", "title", "description", "type",
              "license", "license_url", "source_url")]
            + [("is_published", sql_bool("is_published")), ("tags", sql_json("_tags")),
               ("sql", sql_value("sql"))],
        ).alias("statement"),
    )


def with_fallback(rows: DataFrame, fallback: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` plus the ``fallback`` rows whose key has no row at all."""
    missing = fallback.join(rows.select(*keys), list(keys), "left_anti")
    return rows.unionByName(missing)


def push_batches(
    df: DataFrame,
    send: Callable[[list[str]], None],
    column: str = "statement",
    batch_rows: int = PUSH_BATCH_ROWS,
) -> None:
    """Send ``column`` values to an external sink in chunks of ``batch_rows``,
    one partition at a time on the executors (no driver collect). ``send``
    must be idempotent: a retried task resends its chunks."""

    def per_partition(rows: Iterable) -> None:
        chunk: list[str] = []
        for r in rows:
            chunk.append(r[0])
            if len(chunk) == batch_rows:
                send(chunk)
                chunk = []
        if chunk:
            send(chunk)

    df.select(column).foreachPartition(per_partition)


def export_columns(parsed: DataFrame) -> DataFrame:
    """Column export rows of the documents, parsed once (:func:`export_columns_joined`)."""
    parsed = catalog.parsed_once(parsed)
    return export_columns_joined(catalog.tables(parsed), catalog.columns(parsed))


def export_datasets(dataset_rows: DataFrame) -> DataFrame:
    """Dataset export rows; tags re-rendered as a JSON list (NULL when absent)."""
    tags = F.from_json(F.col("tags_json"), "array<string>")
    return dataset_rows.select(
        "datasource", "title", "description", "cover", "ducklake_url",
        insert_statement(
            "catalog_datasets",
            [(n, sql_value(n)) for n in ("datasource", "title", "description", "cover", "ducklake_url")]
            + [("tags", sql_json(tags))],
        ).alias("statement"),
    )


def export_schemas(schema_rows: DataFrame, *kept: str) -> DataFrame:
    """Schema export rows: id ``ds/schema``, title defaulting to ''."""
    out = schema_rows.select(
        path_key("datasource", "schema_name").alias("id"), "datasource", "schema_name",
        F.coalesce("title", F.lit("")).alias("title"), *kept,
    )
    return out.withColumn(
        "statement",
        insert_statement("catalog_schemas", [(n, sql_value(n)) for n in ("id", "datasource", "schema_name", "title")]),
    )


def export_dependencies(dependency_rows: DataFrame) -> DataFrame:
    """Dependency export rows: id ``ds/alias``."""
    out = dependency_rows.select(
        path_key("datasource", "alias").alias("id"), "datasource", "alias", "ducklake_url"
    )
    return out.withColumn(
        "statement",
        insert_statement("catalog_dependencies",
                         [(n, sql_value(n)) for n in ("id", "datasource", "alias", "ducklake_url")]),
    )


def push(statements: DataFrame, folder: str, batch_rows: int = PUSH_BATCH_ROWS) -> None:
    """Pushes ordered statements (``seq`` from 1, ``statement``) in batches: file
    ``batch-<number>.sql`` of the folder holds batch after batch in order.

    A batch's number and content follow from ``seq`` alone, not from how rows are
    dealt to tasks, and the sink makes files visible only when all tasks are done: a
    task that fails after some of its batches, or runs twice, leaves each batch
    there once. Who applies them can tell by the number what is applied."""
    batch = F.expr(f"(seq - 1) div {batch_rows}").alias("batch")
    grouped = statements.select(batch, "seq", "statement").groupBy("batch").agg(
        F.array_sort(F.collect_list(F.struct("seq", "statement"))).alias("rows")  # at most batch_rows
    )
    write_files(
        grouped.select(
            F.concat(F.lit("batch-"), F.lpad(F.col("batch").cast("string"), 12, "0"), F.lit(".sql")).alias("path"),
            F.array_join(F.transform("rows", lambda r: r["statement"]), "\n").alias("content"),
        ),
        folder,
    )


# --- the whole refresh, in order ----------------------------------------------

_ORDER = ["block", "datasource", "name", "n1", "n2", "n3", "id"]


def _ordered(rows: DataFrame, block: int, table: str, name: str | None = None, places: Sequence[str | int] = (), id_col: str | None = None) -> DataFrame:
    """The rows' statements with the columns that order them."""
    n = [F.col(p).cast("bigint") if isinstance(p, str) else F.lit(p).cast("bigint") for p in [*places, 0, 0, 0][:3]]
    return rows.select(
        F.lit(block).alias("block"), "datasource",
        (F.col(name) if name else F.lit("")).alias("name"),
        *[c.alias(f"n{i}") for i, c in enumerate(n, 1)],
        (F.col(id_col) if id_col else F.lit("")).alias("id"),
        F.lit(table).alias("table"), "statement",
    )


def script(parsed: DataFrame, fallback: DataFrame | None = None) -> DataFrame:
    """(seq, table, statement): a full refresh of the five exported tables.

    Deletes come first; then datasets by name, dependencies by alias, schemas by
    name, tables and columns by their place. ``fallback`` documents follow where the
    datasource has no document of its own: each dataset row, then each of its schemas,
    with its tables, each with its columns. Given unparsed, only those that follow are
    parsed. The statements are staged before they are numbered."""
    parsed = catalog.parsed_once(parsed.drop("_lineage"))  # no statement shows it
    table_rows, column_rows = catalog.tables(parsed), catalog.columns(parsed)
    empty = parsed.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(t) for t in EXPORTED])).alias("n", "t"))
    deletes = empty.select(
        F.lit(0).alias("block"), F.lit("").alias("datasource"), F.lit("").alias("name"),
        F.col("n").cast("bigint").alias("n1"), F.lit(0).cast("bigint").alias("n2"), F.lit(0).cast("bigint").alias("n3"),
        F.lit("").alias("id"), F.col("t").alias("table"),
        F.concat(F.lit("DELETE FROM "), "t", F.lit(";")).alias("statement"),
    )
    parts = [
        deletes,
        _ordered(export_datasets(catalog.datasets(parsed)), 1, "catalog_datasets"),
        _ordered(export_dependencies(catalog.dependencies(parsed)), 2, "catalog_dependencies", "alias"),
        _ordered(export_schemas(catalog.schemas(parsed)), 3, "catalog_schemas", "schema_name"),
        _ordered(export_tables(table_rows, "node_index"), 4, "catalog_tables", None, ["node_index"], "id"),
        _ordered(export_columns_joined(table_rows, column_rows), 5, "catalog_columns", None, ["column_index"], "id"),
    ]
    if fallback is not None:
        own = fallback.join(parsed.select("datasource"), "datasource", "left_anti")
        if "_schemas" not in own.columns:
            own = catalog.parse_documents(own)
        own = catalog.parsed_once(own.drop("_lineage"))
        columns = catalog.columns(own, positions=True).select(
            path_key("datasource", "schema_name", "table_name", "column_name").alias("id"),
            "datasource", "schema_name", "table_name", "column_name", "title",
            F.coalesce("description", F.lit("")).alias("description"), "data_type", "column_index",
            "schema_index", "node_index",
        )
        parts += [
            _ordered(export_datasets(catalog.datasets(own)), 6, "catalog_datasets"),
            _ordered(export_schemas(catalog.schemas(own, positions=True), "schema_index"), 6, "catalog_schemas", None, ["schema_index"]),
            _ordered(export_tables(catalog.tables(own, positions=True), "schema_index", "node_index"), 6, "catalog_tables", None, ["schema_index", "node_index"]),
            _ordered(_with_column_statement(columns), 6, "catalog_columns", None, ["schema_index", "node_index", "column_index"]),
        ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return with_row_numbers(staged(rows, "statements"), _ORDER).select("seq", "table", "statement")
