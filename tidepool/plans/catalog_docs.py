"""Dataset metadata documents derived from the ``part`` table.

The catalog jobs read one nested document per dataset. To run them over
the driver's tables at any scale, every ``part`` row is turned into one
document (so the number of documents grows with the data while each
document stays bounded). The shapes cover the cases the flattening must
handle: 0-3 tables per schema, a schema whose ``tables`` is not an array,
an empty ``tables``, the same table name in two schemas, columns that are
not an array (in the second schema), missing titles / flags, dependencies
absent / empty / partial, and documents without lineage. Each schema is
rendered by one typed ``to_json``.

``part_documents`` builds them in Spark; ``PART_DOCUMENTS_SQL`` is the same
construction in DuckDB SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


# The document is declared as Spark SQL expression text: the JVM parses each
# expression once, instead of one py4j call per Column node.


def _spark_column(j: int) -> str:
    title = "CAST(NULL AS STRING)" if j == 0 else f"'Column {j}'"
    nullable = "CAST(NULL AS BOOLEAN)" if j == 0 else ("false" if j == 1 else "true")
    dtype = "BIGINT" if j % 2 == 0 else "VARCHAR"
    return (
        f"named_struct('name', concat('c{j}_', w1), 'title', {title}, "
        f"'description', concat(p_type, ' {j}'), 'data_type', '{dtype}', 'nullable', {nullable})"
    )


def _spark_table(i: int, columns: str | None = None) -> str:
    w = "w1" if i % 2 == 0 else "w2"
    title = "CAST(NULL AS STRING)" if i == 1 else f"concat(p_name, ' {i}')"
    sql = "CAST(NULL AS STRING)" if i == 2 else f"'select * from t{i}'"
    mat = "table" if i % 2 == 0 else "view"
    if columns is None:
        cols = ", ".join(_spark_column(j) for j in range(3))
        columns = f"slice(array({cols}), 1, CAST((p_partkey + {i}) % 4 AS INT))"
    return (
        f"named_struct('name', concat({w}, '_{i}'), 'title', {title}, 'description', p_type, "
        f"'materialized', '{mat}', 'license', 'CC-BY-4.0', "
        f"'source_url', concat('https://src.example/', p_partkey), "
        f"'published', CASE (p_size + {i}) % 3 WHEN 0 THEN true WHEN 1 THEN false END, "
        f"'tags', array(p_brand, {w}), 'sql', {sql}, 'columns', {columns})"
    )


_NODE = (
    "named_struct('fqn', {fqn}, 'resource_type', '{rtype}', "
    "'config', named_struct('materialized', '{mat}'), 'meta', {meta})"
)
_NO_META = "CAST(map() AS MAP<STRING, STRING>)"
_NO_LIST = "CAST(array() AS ARRAY<STRING>)"

_DOCUMENT_EXPRS = [
    "concat('ds', p_partkey) AS datasource",
    "p_name AS title",
    "p_type AS description",
    "CASE WHEN p_size % 4 <> 0 THEN p_brand END AS cover",
    "to_json(split(p_name, ' ')) AS tags",
    "concat('https://lake.example.org/ds', p_partkey, '/lake.db') AS ducklake_url",
    "concat('{\"main\":', to_json(named_struct('title', p_brand, 'tables', "
    f"slice(array({_spark_table(0)}, {_spark_table(1)}, {_spark_table(2)}), 1, CAST(p_size % 4 AS INT)))), "
    "',\"extra\":', CASE p_size % 3 "
    "WHEN 0 THEN to_json(named_struct('title', p_type, 'tables', 'none')) "
    f"WHEN 1 THEN to_json(named_struct('title', p_type, 'tables', {_NO_LIST})) "
    f"ELSE to_json(named_struct('title', p_type, 'tables', array({_spark_table(0, chr(39) + 'n/a' + chr(39))}))) END, "
    "'}') AS schemas",
    "CASE p_size % 3 WHEN 1 THEN '[]' WHEN 2 THEN to_json(array("
    "named_struct('alias', concat('a_', w1), 'ducklake_url', concat('https://lake.example.org/', p_brand)), "
    "named_struct('alias', concat('b_', w2), 'ducklake_url', CAST(NULL AS STRING)))) END AS dependencies",
    "CASE WHEN p_size % 7 <> 0 THEN to_json(named_struct("
    "'parent_map', map(concat('stg_', w1), array(concat('raw_', w1)), "
    "concat('mart_', w2), array(concat('stg_', w1), concat('raw_', w2)), "
    f"concat('raw_', w1), {_NO_LIST}), "
    "'nodes', map("
    "concat('stg_', w1), "
    + _NODE.format(fqn="array(concat('ds', p_partkey), 'stg', concat('stg_', w1))", rtype="model", mat="view",
                   meta=_NO_META)
    + ", concat('mart_', w2), "
    + _NODE.format(fqn="array(concat('ds', p_partkey), 'mart', concat('mart_', w2))", rtype="model",
                   mat="table", meta="map('title', p_name)")
    + ", concat('raw_', w1), "
    + _NODE.format(fqn=_NO_LIST, rtype="seed", mat="seed", meta=_NO_META)
    + "))) END AS lineage",
    "CASE WHEN p_size % 5 <> 0 THEN concat('About ', p_name) END AS readme",
]


def part_documents(part: DataFrame) -> DataFrame:
    """One document per part row. A document is some hundred times the bytes its row
    takes in a file, so the narrow rows are dealt out first: few file splits would
    leave all documents to as few tasks."""
    columns = ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]
    words = part.select(*columns).repartition(*columns).selectExpr(
        "*",
        "split(p_name, ' ')[0] AS w1",
        "coalesce(get(split(p_name, ' '), 1), split(p_name, ' ')[0]) AS w2",
    )
    return words.selectExpr(*_DOCUMENT_EXPRS)


def _sql_column(j: int) -> str:
    title = "NULL" if j == 0 else f"'Column {j}'"
    nullable = "NULL" if j == 0 else ("false" if j == 1 else "true")
    dtype = "BIGINT" if j % 2 == 0 else "VARCHAR"
    return (
        f"json_object('name', 'c{j}_' || w1, 'title', {title}, "
        f"'description', p_type || ' {j}', 'data_type', '{dtype}', 'nullable', {nullable})"
    )


def _sql_table(i: int, columns: str | None = None) -> str:
    w = "w1" if i % 2 == 0 else "w2"
    title = "NULL" if i == 1 else f"p_name || ' {i}'"
    sql = "NULL" if i == 2 else f"'select * from t{i}'"
    mat = "table" if i % 2 == 0 else "view"
    if columns is None:
        cols = ", ".join(_sql_column(j) for j in range(3))
        columns = f"to_json(list_slice([{cols}], 1, CAST((k + {i}) % 4 AS INTEGER)))"
    return (
        f"json_object('name', {w} || '_{i}', 'title', {title}, 'description', p_type, "
        f"'materialized', '{mat}', 'license', 'CC-BY-4.0', "
        f"'source_url', 'https://src.example/' || k, "
        f"'published', CASE (s + {i}) % 3 WHEN 0 THEN true WHEN 1 THEN false END, "
        f"'tags', json_array(p_brand, {w}), 'sql', {sql}, "
        f"'columns', {columns})"
    )


PART_DOCUMENTS_SQL = f"""
stg_catalog AS (
  SELECT
    'ds' || k AS datasource,
    p_name AS title,
    p_type AS description,
    CASE WHEN s % 4 <> 0 THEN p_brand END AS cover,
    to_json(string_split(p_name, ' ')) AS tags,
    'https://lake.example.org/ds' || k || '/lake.db' AS ducklake_url,
    json_object(
      'main', json_object('title', p_brand, 'tables',
                          to_json(list_slice([t0, t1, t2], 1, CAST(s % 4 AS INTEGER)))),
      'extra', json_object('title', p_type, 'tables',
                           CASE s % 3 WHEN 0 THEN to_json('none') WHEN 1 THEN json_array()
                                ELSE to_json([t0_cols_text]) END)
    ) AS schemas,
    CASE s % 3
      WHEN 1 THEN json_array()
      WHEN 2 THEN json_array(
        json_object('alias', 'a_' || w1, 'ducklake_url', 'https://lake.example.org/' || p_brand),
        json_object('alias', 'b_' || w2))
    END AS dependencies,
    CASE WHEN s % 7 <> 0 THEN json_object(
      'parent_map', json_object(
         'stg_' || w1, json_array('raw_' || w1),
         'mart_' || w2, json_array('stg_' || w1, 'raw_' || w2),
         'raw_' || w1, json_array()),
      'nodes', json_object(
         'stg_' || w1, json_object('fqn', json_array('ds' || k, 'stg', 'stg_' || w1),
             'resource_type', 'model', 'config', json_object('materialized', 'view'),
             'meta', json_object()),
         'mart_' || w2, json_object('fqn', json_array('ds' || k, 'mart', 'mart_' || w2),
             'resource_type', 'model', 'config', json_object('materialized', 'table'),
             'meta', json_object('title', p_name)),
         'raw_' || w1, json_object('fqn', json_array(),
             'resource_type', 'seed', 'config', json_object('materialized', 'seed'),
             'meta', json_object()))
    ) END AS lineage,
    CASE WHEN s % 5 <> 0 THEN 'About ' || p_name END AS readme
  FROM (
    SELECT *, {_sql_table(0)} AS t0, {_sql_table(1)} AS t1, {_sql_table(2)} AS t2,
           {_sql_table(0, "'n/a'")} AS t0_cols_text
    FROM (
      SELECT p_partkey AS k, p_name, p_brand, p_type, p_size AS s,
             string_split(p_name, ' ')[1] AS w1,
             coalesce(string_split(p_name, ' ')[2], string_split(p_name, ' ')[1]) AS w2
      FROM part
    ) base
  ) tj
)"""
