"""API result rows → tables.

Fetched batches land as JSON-lines files under
``<root>/_area_code=XX/_year=YYYY/_quarter=Q/``; the reader declares every
field as optional text (fields vary by row) and the request keys as typed
partition columns, so ``'01'`` stays text.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fields of a property-price row (all optional text).
TRADE_PRICE_FIELDS = [
    "Type", "Region", "MunicipalityCode", "Prefecture", "Municipality", "DistrictName",
    "TradePrice", "PricePerUnit", "FloorPlan", "Area", "UnitPrice", "LandShape", "Frontage",
    "TotalFloorArea", "BuildingYear", "Structure", "Use", "Purpose", "Direction",
    "Classification", "Breadth", "CityPlanning", "CoverageRatio", "FloorAreaRatio", "Period",
    "Renovation", "Remarks", "PriceCategory", "DistrictCode",
]
REQUEST_KEYS = T.StructType(
    [
        T.StructField("_area_code", T.StringType()),
        T.StructField("_year", T.IntegerType()),
        T.StructField("_quarter", T.IntegerType()),
    ]
)


def text_schema(fields: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


def read_batches(
    spark: SparkSession, root: str, fields: Sequence[str] = TRADE_PRICE_FIELDS, fmt: str = "json"
) -> DataFrame:
    """All landed batches with their request keys (partition columns)."""
    schema = T.StructType(text_schema(fields).fields + REQUEST_KEYS.fields)
    return spark.read.schema(schema).option("basePath", root).format(fmt).load(root)


def rows_frame(
    spark: SparkSession,
    rows: Iterable[Mapping[str, object]],
    fields: Sequence[str] = TRADE_PRICE_FIELDS,
    tags: Mapping[str, object] | None = None,
) -> DataFrame:
    """One small batch of API rows → DataFrame (declared text fields, extra
    fields ignored, missing ones NULL), tagged with the request keys."""
    data = [tuple(None if r.get(f) is None else str(r.get(f)) for f in fields) for r in rows]
    df = spark.createDataFrame(data, text_schema(fields))
    for k, v in (tags or {}).items():
        df = df.withColumn(k, F.lit(v))
    return df
