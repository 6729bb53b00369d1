"""TopoJSON boundaries → one row per feature with GeoJSON geometry text.

TopoJSON stores shared borders once as *arcs*; a polygon ring lists arc
indexes, a negative index ``~i`` meaning arc ``i`` reversed. With a
``transform`` the arc points are quantised and delta-coded. Spark
geospatial types are off by default, so geometries are emitted as
GeoJSON text (``Polygon`` / ``MultiPolygon``).

Plan (all JVM-side): each topology is parsed once and decoded inside its
row — arcs by prefix sums, rings by chaining arc references — then its
features are exploded: no shuffle, window or broadcast. A topology is one
document; its size is bounded by the file that holds it.

All geometry types are kept: points, lines, polygons and their multi forms;
an object may be a collection or a bare geometry. A feature without a type
has a NULL geometry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.session import prepare

_GEOMETRY = "type:string,arcs:string,coordinates:string,properties:map<string,string>"
TOPOLOGY_SCHEMA = (
    "struct<transform:struct<scale:array<double>,translate:array<double>>,"
    "arcs:array<array<array<double>>>,"
    f"objects:map<string,struct<{_GEOMETRY},geometries:array<struct<{_GEOMETRY}>>>>>"
)

# A stored position → coordinates; without a transform positions are absolute.
_SCALED = "CASE WHEN size({t}.scale) = 2 THEN array({x} * {t}.scale[0] + {t}.translate[0], {y} * {t}.scale[1] + {t}.translate[1]) ELSE array({x}, {y}) END"



def _running_sums(values: str) -> str:
    """Prefix sums of an array of doubles by doubling: after step k each item holds
    the sum of the last 2^(k+1) items up to it. n log n additions and no array
    that grows by copying, however long the arc."""
    return (
        f"CASE WHEN size({values}) < 2 THEN {values} ELSE aggregate("
        f"sequence(0, CAST(ceil(log2(size({values}))) AS INT) - 1), {values}, "
        "(acc, k) -> transform(acc, (v, i) -> CASE WHEN i >= shiftleft(1, k) THEN v + acc[i - shiftleft(1, k)] ELSE v END)) END"
    )


# The points of every arc: running sums of the deltas when quantised.
_ARC_POINTS = (
    "transform(t.arcs, a -> CASE WHEN size(t.transform.scale) = 2 THEN zip_with("
    f"{_running_sums('transform(a, p -> p[0])')}, {_running_sums('transform(a, p -> p[1])')}, (x, y) -> array("
    "x * t.transform.scale[0] + t.transform.translate[0], y * t.transform.scale[1] + t.transform.translate[1])) "
    "ELSE transform(a, p -> array(p[0], p[1])) END)"
)


def _line(refs: str) -> str:
    """Points of chained arcs: ``~i`` is arc i backwards, and the point that an
    arc shares with the one before it stands once."""
    arc = "(CASE WHEN r >= 0 THEN _arcs[r] ELSE reverse(_arcs[-r - 1]) END)"
    return f"flatten(transform({refs}, (r, i) -> CASE WHEN i = 0 THEN {arc} ELSE slice({arc}, 2, greatest(size({arc}) - 1, 0)) END))"


def _geojson(kind: str, coordinates: str) -> str:
    return f"WHEN _g.type = '{kind}' THEN to_json(named_struct('type', '{kind}', 'coordinates', {coordinates}))"


def _position(p: str) -> str:
    return _SCALED.format(t="_transform", x=f"{p}[0]", y=f"{p}[1]")


_GEOMETRY_TEXT = "CASE " + " ".join([
    _geojson("Point", f"transform(array(from_json(_g.coordinates, 'array<double>')), p -> {_position('p')})[0]"),
    _geojson("MultiPoint", f"transform(from_json(_g.coordinates, 'array<array<double>>'), p -> {_position('p')})"),
    _geojson("LineString", _line("from_json(_g.arcs, 'array<int>')")),
    _geojson("MultiLineString", f"transform(from_json(_g.arcs, 'array<array<int>>'), l -> {_line('l')})"),
    "WHEN _g.arcs IS NULL OR _g.arcs IN ('[]', '[[]]') THEN NULL",
    _geojson("Polygon", f"transform(from_json(_g.arcs, 'array<array<int>>'), l -> {_line('l')})"),
    _geojson("MultiPolygon", f"transform(from_json(_g.arcs, 'array<array<array<int>>>'), m -> transform(m, l -> {_line('l')}))"),
]) + " END"


def decode_topologies(texts: DataFrame, object_name: str | None = None) -> DataFrame:
    """Topology JSON text rows (source, value) → features: (source, object,
    feature_index, type, properties map, geometry GeoJSON text)."""
    topo = texts.select("source", F.from_json("value", TOPOLOGY_SCHEMA).alias("t"))
    topo = topo.selectExpr("source", "t.transform AS _transform", "t.objects AS _objects", f"{_ARC_POINTS} AS _arcs")
    feats = topo.select("source", "_transform", "_arcs", F.explode("_objects").alias("object", "_o"))
    if object_name is not None:
        feats = feats.where(F.col("object") == object_name)
    bare = "array(named_struct('type', _o.type, 'arcs', _o.arcs, 'coordinates', _o.coordinates, 'properties', _o.properties))"
    listed = f"CASE WHEN _o.geometries IS NOT NULL THEN _o.geometries WHEN _o.type IS NOT NULL THEN {bare} END"
    # a feature's geometry is decoded in the topology's row, so the arcs are not copied per feature
    decoded = (
        f"transform({listed}, _g -> named_struct('type', _g.type, 'properties', _g.properties, 'geometry', {_GEOMETRY_TEXT}))"
    )
    return feats.selectExpr("source", "object", f"posexplode({decoded}) AS (feature_index, _f)").select(
        "source", "object", "feature_index", "_f.type", "_f.properties", "_f.geometry"
    )


def read_topojson(spark: SparkSession, paths: str | list[str], object_name: str | None = None) -> DataFrame:
    """Features of TopoJSON files (one topology per file)."""
    prepare(spark)
    text = spark.read.text(paths if isinstance(paths, list) else [paths], wholetext=True)
    return decode_topologies(text.select(F.col("_metadata.file_path").alias("source"), "value"), object_name)
