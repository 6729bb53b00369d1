"""TopoJSON topologies derived from the ``part`` table.

One small topology per ``part`` row (so the work grows with the data and
each topology stays bounded): quantised, delta-coded arcs scaled by
``[0.5, 0.25]`` and translated by ``[k, -k]`` (k = part key), three
features — a polygon walking two arcs, the same square walked through both
arcs reversed, and either a multipolygon (square + triangle) or a polygon
(triangle) depending on the part size. ``part_topologies`` builds the JSON
in Spark; ``EXPECTED_BOUNDARIES_SQL`` writes the decoded GeoJSON directly in
DuckDB for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

_K = "CAST(p_partkey AS STRING)"
_S = "CAST(p_size AS STRING)"
_S2 = "CAST(2 * p_size AS STRING)"
_S2P = "CAST(2 * p_size + 1 AS STRING)"


def _props(suffix: str, name_col: str) -> str:
    return (f"to_json(named_struct('prefecture_code', concat({_K}, '-{suffix}'), "
            f"'prefecture_name', {name_col}, 'lg_code', concat('{suffix}', lpad({_K}, 5, '0')), "
            f"'county_name', CASE WHEN p_size % 2 = 1 THEN p_type END, 'city_name', p_name))")


_TOPOLOGY = (
    "concat("
    "'{\"type\":\"Topology\",\"transform\":{\"scale\":[0.5,0.25],\"translate\":[', " + _K + ", ',', "
    "CAST(-p_partkey AS STRING), ']},\"arcs\":[[[0,0],[', " + _S + ", ',0],[0,', " + _S + ", ']],"
    "[[', " + _S + ", ',', " + _S + ", '],[-', " + _S + ", ',0],[0,-', " + _S + ", ']],"
    "[[', " + _S2 + ", ',', " + _S2 + ", '],[1,0],[0,1],[-1,-1]]],"
    "\"objects\":{\"pref\":{\"type\":\"GeometryCollection\",\"geometries\":["
    "{\"type\":\"Polygon\",\"arcs\":[[0,1]],\"properties\":', " + _props("a", "p_brand") + ", '},"
    "{\"type\":\"Polygon\",\"arcs\":[[-2,-1]],\"properties\":', " + _props("b", "p_type") + ", '},"
    "{\"type\":', CASE WHEN p_size % 2 = 0 THEN '\"MultiPolygon\",\"arcs\":[[[0,1]],[[2]]]' "
    "ELSE '\"Polygon\",\"arcs\":[[2]]' END, ',\"properties\":', " + _props("c", "p_name") + ", '}]}}}')"
)


def part_topologies(part: DataFrame) -> DataFrame:
    """(source, value): one TopoJSON text per part row."""
    return part.selectExpr(f"concat('part-', {_K}) AS source", f"{_TOPOLOGY} AS value")


def _pt(qx: str, qy: str) -> str:
    return (f"'[' || CAST(({qx}) * 0.5 + p_partkey AS DOUBLE)::VARCHAR || ',' || "
            f"CAST(({qy}) * 0.25 - p_partkey AS DOUBLE)::VARCHAR || ']'")


_SQUARE = ("'[' || " + " || ',' || ".join(
    _pt(x, y) for x, y in [("0", "0"), ("p_size", "0"), ("p_size", "p_size"), ("0", "p_size"), ("0", "0")]) + " || ']'")
_SQUARE_BACK = ("'[' || " + " || ',' || ".join(
    _pt(x, y) for x, y in [("0", "0"), ("0", "p_size"), ("p_size", "p_size"), ("p_size", "0"), ("0", "0")]) + " || ']'")
_TRIANGLE = ("'[' || " + " || ',' || ".join(
    _pt(x, y) for x, y in [("2 * p_size", "2 * p_size"), ("2 * p_size + 1", "2 * p_size"),
                           ("2 * p_size + 1", "2 * p_size + 1"), ("2 * p_size", "2 * p_size")]) + " || ']'")

# Further properties of the features, by the suffix of their prefecture code.
EXPECTED_MUNICIPALITIES_SQL = """
SELECT concat(right(prefecture_code, 1), lpad(CAST(p_partkey AS VARCHAR), 5, '0')) AS lg_code, prefecture_code, prefecture_name,
       CASE WHEN p_size % 2 = 1 THEN p_type END AS county_name, p_name AS city_name, geometry
FROM ({}) AS b JOIN part ON CAST(p_partkey AS VARCHAR) = left(prefecture_code, -2)
"""

EXPECTED_BOUNDARIES_SQL = f"""
SELECT p_partkey || '-a' AS prefecture_code, p_brand AS prefecture_name,
       '{{"type":"Polygon","coordinates":[' || {_SQUARE} || ']}}' AS geometry
FROM part
UNION ALL
SELECT p_partkey || '-b', p_type, '{{"type":"Polygon","coordinates":[' || {_SQUARE_BACK} || ']}}'
FROM part
UNION ALL
SELECT p_partkey || '-c', p_name,
       CASE WHEN p_size % 2 = 0
            THEN '{{"type":"MultiPolygon","coordinates":[[' || {_SQUARE} || '],[' || {_TRIANGLE} || ']]}}'
            ELSE '{{"type":"Polygon","coordinates":[' || {_TRIANGLE} || ']}}' END
FROM part
"""
