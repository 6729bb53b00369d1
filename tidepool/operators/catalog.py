"""Metadata documents → relational catalog (datasets, schemas, tables,
columns, dependencies, lineage, search entries).

Input is one row per dataset document with the nested parts kept as JSON
text (``tags``, ``schemas``, ``dependencies``, ``lineage``), as written by
:func:`tidepool.sources.documents.read_metadata_documents`. Each JSON part
is parsed once per row with a full typed schema (:func:`parse_documents`);
every mart below is then a projection / ``explode`` of that parse. Search
entries and tag texts join table and column rows on (datasource, table name):
one plan for every size, whether a datasource has one document or several.

Semantics kept from the publishing SQL:
* schemas whose ``tables`` is not an array, tables whose ``columns`` is not
  an array, and empty arrays produce no rows;
* table and column indexes are 1-based;
* ``published`` defaults to false and ``nullable`` to true, column title to '';
* lineage rows exist only for documents that carry lineage;
* search entries join columns to tables on (datasource, table name) only,
  so equal table names in two schemas fan out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.text import underscore_words
from tidepool.operators.ordering import staged

_COLUMN_T = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("name", "title", "description", "data_type", "nullable")]
)
_TABLE_T = T.StructType(
    [T.StructField(n, T.StringType()) for n in
     ("name", "title", "description", "materialized", "license", "license_url", "source_url",
      "published", "tags", "sql")]
    + [T.StructField("columns", T.ArrayType(_COLUMN_T))]
)
# Nested values typed as string (tags, fqn, meta, published, nullable) come
# back as compact JSON text; a value of the wrong shape becomes NULL without
# failing the rest of the document.
SCHEMAS_SCHEMA = f"map<string,struct<title:string,tables:array<{_TABLE_T.simpleString()}>>>"
DEPENDENCIES_SCHEMA = "array<struct<alias:string,ducklake_url:string>>"
LINEAGE_SCHEMA = (
    "struct<parent_map:map<string,array<string>>,"
    "nodes:map<string,struct<fqn:string,resource_type:string,"
    "config:struct<materialized:string>,meta:string>>>"
)


def parse_documents(docs: DataFrame) -> DataFrame:
    """Parse the JSON parts of each document once (typed, partial results)."""
    return docs.select(
        "datasource",
        "title",
        "description",
        "cover",
        "ducklake_url",
        "readme",
        F.col("tags").alias("tags_json"),
        F.from_json("schemas", SCHEMAS_SCHEMA).alias("_schemas"),
        F.from_json("dependencies", DEPENDENCIES_SCHEMA).alias("_deps"),
        F.from_json("lineage", LINEAGE_SCHEMA).alias("_lineage"),
    )


def datasets(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        "datasource", "title", "description", "cover", "ducklake_url", "tags_json", "readme"
    )


# The row-level expressions below are Spark SQL text (higher-order functions
# over the parsed document): the JVM parses each once, instead of one py4j
# call per expression node.

# array<struct<schema_index, schema_name, node_index, t>> of one document, in document order
DOC_TABLES = (
    "flatten(transform(map_entries(coalesce(_schemas, map())), (e, k) -> "
    "transform(coalesce(e.value.tables, array()), (t, i) -> "
    "named_struct('schema_index', k + 1, 'schema_name', e.key, 'node_index', i + 1, 't', t))))"
)


def parsed_once(parsed: DataFrame) -> DataFrame:
    """The typed parse as a columnar copy in the shared folder: marts that are
    joined with each other read (and prune) it instead of parsing again."""
    return staged(parsed, "parsed")


def with_doc_tables(parsed: DataFrame) -> DataFrame:
    """(datasource, _tabs): the document's tables flattened over its schemas."""
    return parsed.selectExpr("datasource", f"{DOC_TABLES} AS _tabs")


def schemas(parsed: DataFrame, positions: bool = False) -> DataFrame:
    """Schema rows; with ``positions`` also their place in the document."""
    # entries are slimmed to (key, title) before exploding, so the nested
    # tables are not copied into every output row
    rows = parsed.selectExpr(
        "datasource",
        "explode(transform(map_entries(coalesce(_schemas, map())), "
        "(e, k) -> named_struct('schema_index', k + 1, 'schema_name', e.key, 'title', e.value.title))) AS _s",
    ).select("datasource", "_s.*")
    return rows if positions else rows.drop("schema_index")


_TABLE_ROW = (
    "named_struct('node_id', concat('model.', datasource, '.', u.t.name), 'node_index', u.node_index, "
    "'name', u.t.name, 'schema_name', u.schema_name, 'description', u.t.description, "
    "'materialized', u.t.materialized, 'title', u.t.title, 'license', u.t.license, "
    "'license_url', u.t.license_url, 'source_url', u.t.source_url, "
    "'is_published', coalesce(try_cast(u.t.published AS BOOLEAN), false), "
    "'tags_json', u.t.tags, 'sql', u.t.sql, 'schema_index', u.schema_index)"
)


def tables(parsed: DataFrame, positions: bool = False) -> DataFrame:
    """Table rows; with ``positions`` also the place of their schema."""
    rows = (
        with_doc_tables(parsed)
        .selectExpr("datasource", f"explode(transform(_tabs, u -> {_TABLE_ROW})) AS _t")
        .select("datasource", "_t.*")
    )
    return rows if positions else rows.drop("schema_index")


_COLUMN_ROW = (
    "named_struct('node_id', concat('model.', datasource, '.', u.t.name), 'table_name', u.t.name, "
    "'column_name', c.name, 'column_index', j + 1, 'title', coalesce(c.title, ''), "
    "'description', c.description, 'data_type', c.data_type, "
    "'nullable', try_cast(coalesce(c.nullable, 'true') AS BOOLEAN), "
    "'schema_index', u.schema_index, 'schema_name', u.schema_name, 'node_index', u.node_index)"
)


def columns(parsed: DataFrame, positions: bool = False) -> DataFrame:
    """Column rows; with ``positions`` also schema name and places of schema and table."""
    rows = (
        with_doc_tables(parsed)
        .selectExpr(
            "datasource",
            "explode(flatten(transform(_tabs, u -> transform(coalesce(u.t.columns, array()), "
            f"(c, j) -> {_COLUMN_ROW})))) AS _c",
        )
        .select("datasource", "_c.*")
    )
    return rows if positions else rows.drop("schema_index", "schema_name", "node_index")


def dependencies(parsed: DataFrame) -> DataFrame:
    return parsed.select("datasource", F.explode("_deps").alias("_d")).select(
        "datasource",
        F.col("_d.alias").alias("alias"),
        F.col("_d.ducklake_url").alias("ducklake_url"),
    )


def lineage_edges(parsed: DataFrame) -> DataFrame:
    # documents without lineage explode to no rows; referencing only
    # parent_map lets the JSON parse skip the nodes
    return parsed.select("datasource", F.explode("_lineage.parent_map").alias("child", "_parents")).select(
        "datasource", "child", F.explode("_parents").alias("parent")
    )


def lineage_nodes(parsed: DataFrame) -> DataFrame:
    # documents without lineage explode to no rows
    return parsed.selectExpr(
        "datasource",
        "explode(transform(map_entries(_lineage.nodes), e -> named_struct('name', e.key, "
        "'resource_type', e.value.resource_type, 'materialized', e.value.config.materialized, "
        "'fqn_json', e.value.fqn, 'meta_json', e.value.meta))) AS _n",
    ).select("datasource", "_n.*")


def table_tag_text(table_rows: DataFrame) -> DataFrame:
    """Tags of all tables sharing (datasource, name), joined by spaces.

    Ordered by schema name, table index, then tag position. Groups are
    bounded by one document, and the aggregation combines map-side.
    """
    tagged = table_rows.select(
        "datasource",
        "name",
        "schema_name",
        "node_index",
        F.posexplode(F.from_json("tags_json", "array<string>")).alias("_tpos", "_tag"),
    )
    ordered = F.array_sort(
        F.collect_list(F.struct("schema_name", "node_index", "_tpos", "_tag"))
    )
    return tagged.groupBy("datasource", "name").agg(
        F.array_join(F.transform(ordered, lambda x: x["_tag"]), " ").alias("tags_text")
    )


def _text_or_blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def search_entries_joined(table_rows: DataFrame, column_rows: DataFrame) -> DataFrame:
    """Search entries from table and column rows, by equi-joins on (datasource,
    table name): a datasource may span several documents, and a document with
    many tables is spread over the shuffle partitions."""
    tags = table_tag_text(table_rows)
    t = table_rows.alias("t")
    table_entries = t.join(tags.alias("ta"), ["datasource", "name"], "left").select(
        F.lit("table").alias("entry_type"),
        "datasource",
        F.col("t.schema_name").alias("schema_name"),
        F.col("name").alias("table_name"),
        F.col("t.title").alias("table_title"),
        F.lit(None).cast("string").alias("column_name"),
        F.col("t.description").alias("description"),
        F.concat_ws(
            " ",
            _text_or_blank(underscore_words(F.col("name"))),
            _text_or_blank(F.col("t.title")),
            _text_or_blank(F.col("t.description")),
            _text_or_blank(F.col("ta.tags_text")),
        ).alias("search_text"),
        F.concat(
            F.lit("/datasets/"), F.col("datasource"), F.lit("/"), F.col("t.schema_name"),
            F.lit("/"), F.col("name"),
        ).alias("href"),
    )
    c = column_rows.alias("c")
    tt = table_rows.select(
        F.col("datasource").alias("_tds"), F.col("name").alias("_tname"),
        F.col("schema_name").alias("_tschema"), F.col("title").alias("_ttitle"),
    )
    column_entries = c.join(
        tt, (F.col("c.datasource") == F.col("_tds")) & (F.col("c.table_name") == F.col("_tname")), "left"
    ).select(
        F.lit("column").alias("entry_type"),
        F.col("c.datasource").alias("datasource"),
        F.col("_tschema").alias("schema_name"),
        F.col("c.table_name").alias("table_name"),
        F.col("_ttitle").alias("table_title"),
        F.col("c.column_name").alias("column_name"),
        F.col("c.description").alias("description"),
        F.concat_ws(
            " ",
            _text_or_blank(underscore_words(F.col("c.column_name"))),
            _text_or_blank(F.col("c.title")),
            _text_or_blank(F.col("c.description")),
            _text_or_blank(underscore_words(F.col("c.table_name"))),
        ).alias("search_text"),
        F.concat(
            F.lit("/datasets/"), F.col("c.datasource"), F.lit("/"), F.col("_tschema"),
            F.lit("/"), F.col("c.table_name"),
        ).alias("href"),
    )
    return table_entries.unionByName(column_entries)


def tag_text(parsed: DataFrame) -> DataFrame:
    """Tag text per table name that has tags (:func:`table_tag_text`)."""
    return table_tag_text(tables(parsed))


def search_entries(parsed: DataFrame) -> DataFrame:
    """One search row per table and per column of the parsed documents (parsed once)."""
    return _search_entries(parsed_once(parsed))


def _search_entries(parsed: DataFrame) -> DataFrame:
    return search_entries_joined(tables(parsed), columns(parsed))


def tables_by_schema(parsed: DataFrame) -> DataFrame:
    """Per (datasource, schema) holding tables: table names in index order,
    table count, and the dataset's total table count."""
    per_schema = (
        "transform(map_entries(coalesce(_schemas, map())), e -> named_struct('schema_name', e.key, "
        "'table_list', array_join(transform(coalesce(e.value.tables, array()), t -> t.name), ','), "
        "'n_tables', CAST(size(coalesce(e.value.tables, array())) AS BIGINT)))"
    )
    return (
        parsed.selectExpr("datasource", f"{per_schema} AS _s")
        .selectExpr(
            "datasource",
            "aggregate(_s, CAST(0 AS BIGINT), (acc, x) -> acc + x.n_tables) AS total_tables",
            "explode(filter(_s, x -> x.n_tables > 0)) AS _x",
        )
        .select("datasource", "_x.schema_name", "_x.table_list", "_x.n_tables", "total_tables")
    )


# --- publishing ----------------------------------------------------------------

MARTS = {
    "mart_datasets": datasets,
    "mart_schemas": schemas,
    "mart_tables": tables,
    "mart_columns": columns,
    "mart_dependencies": dependencies,
    "mart_lineage_edges": lineage_edges,
    "mart_lineage_nodes": lineage_nodes,
    "mart_search_entries": _search_entries,
}


def publish(docs: DataFrame, root: str) -> dict[str, str]:
    """Write every catalog mart under ``root`` (parquet, overwrite).

    The documents are parsed once and the typed parse is written to
    ``root/_parsed``; each mart is then computed from that columnar copy
    (nested-column pruning reads only what a mart needs) instead of
    re-parsing the JSON per mart, and the lineage back to the raw documents
    is cut. Returns mart name → path."""
    spark = docs.sparkSession
    parsed_path = f"{root.rstrip('/')}/_parsed"
    parse_documents(docs).write.mode("overwrite").parquet(parsed_path)
    parsed = spark.read.parquet(parsed_path)
    out = {}
    for name, build in MARTS.items():
        path = f"{root.rstrip('/')}/{name}"
        build(parsed).write.mode("overwrite").parquet(path)
        out[name] = path
    return out
