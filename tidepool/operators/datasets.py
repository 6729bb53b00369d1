"""Composite dataset jobs (raw → stg → mart) built from the operators.

Each job is a function ``DataFrame(s) → DataFrame`` and stays lazy; the
caller materialises the mart with a sink.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.casts import text_array
from tidepool.functions.codes import with_check_digit
from tidepool.operators.reshape import label_case, rename_cast, unpivot_drop_nulls, union_all
from tidepool.operators.statistics import category_view

# --- population: wide CSV → long table ---------------------------------------

# Leading columns of the municipal population CSV and their names.
POPULATION_KEYS = [
    ("全国地方公共団体コード", "lg_code"),
    ("地域コード", "area_code"),
    ("地方公共団体名", "lg_name"),
    ("調査年月日", "reference_date"),
    ("地域名", "area_name"),
]
# Five-year age bands 0-4 … 80-84, then 85 and over.
AGE_BANDS = [(lo, lo + 4) for lo in range(0, 85, 5)]
SEXES = [("男性", "male"), ("女性", "female")]


def population_columns() -> list[tuple[str, str]]:
    """(source column, wide name) of the 36 age × sex columns, by rule."""
    out = []
    for lo, hi in AGE_BANDS:
        for jp, en in SEXES:
            out.append((f"{lo}-{hi}歳の{jp}", f"{en}_{lo}_{hi}"))
    for jp, en in SEXES:
        out.append((f"85歳以上の{jp}", f"{en}_85_plus"))
    return out


def population_csv_types() -> dict[str, str]:
    """Types by column name for :func:`tidepool.sources.csv.read_csv_named`."""
    types = {"調査年月日": "date"}
    types.update({src: "bigint" for src, _ in population_columns()})
    return types


def age_group_rules() -> list[tuple[str, str]]:
    rules = [(f"%_{lo}_{hi}", f"{lo}-{hi}") for lo, hi in AGE_BANDS]
    return rules + [("%_85_plus", "85+")]


def population_long(raw: DataFrame) -> DataFrame:
    """Wide population table → (keys…, sex, age_group, population); empty
    cells produce no row."""
    spec = [(src, dst, None) for src, dst in POPULATION_KEYS]
    spec += [(src, dst, None) for src, dst in population_columns()]
    renamed = rename_cast(raw, spec)
    keys = [dst for _, dst in POPULATION_KEYS]
    values = [dst for _, dst in population_columns()]
    long = unpivot_drop_nulls(renamed, keys, values, "age_sex", "population")
    return long.select(
        *keys,
        label_case("age_sex", [("male_%", "male")], "female").alias("sex"),
        label_case("age_sex", age_group_rules()).alias("age_group"),
        F.col("population").cast("bigint").alias("population"),
    )


def population_all_periods(periods: Iterable[DataFrame]) -> DataFrame:
    """Long tables of several periods, UNION ALL (apply to one multi-path
    read when the periods share a layout)."""
    return union_all(population_long(p) for p in periods)


# --- postal codes -------------------------------------------------------------

POSTAL_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in (
        "lg_code", "old_zipcode", "zipcode", "prefecture_kana", "city_kana", "town_kana",
        "prefecture", "city", "town")]
    + [T.StructField(n, T.IntegerType()) for n in (
        "has_multiple_zipcodes", "has_koaza_banchi", "has_chome", "has_multiple_towns",
        "update_status", "update_reason")]
)


def postal_codes(raw: DataFrame) -> DataFrame:
    """Postal rows with the 5-digit local-government code extended by its
    check digit."""
    return raw.select(
        with_check_digit("lg_code").alias("lg_code"),
        *[c for c in raw.columns if c != "lg_code"],
    )


# --- statistics category views ------------------------------------------------

CATEGORY_PREFIXES = list("ABCDEFGHIJK")
STAT_VIEW_LABELS = {
    "item_name": ("cat01_metadata", "$.name"),
    "area_name": ("area_metadata", "$.name"),
    "time_name": ("time_metadata", "$.name"),
}


def statistics_view(facts: DataFrame, prefix: str | None = None) -> DataFrame:
    view = category_view(
        facts, "cat01", ["cat01", "area", "time", "unit", "value"], STAT_VIEW_LABELS, prefix
    )
    return view.select("cat01", "item_name", "area", "area_name", "time", "time_name", "unit", "value")


def statistics_views(facts: DataFrame, prefixes: Iterable[str] = CATEGORY_PREFIXES) -> dict[str, DataFrame]:
    """One lazy view per category prefix (each a pushed-down prefix filter)."""
    return {p: statistics_view(facts, p) for p in prefixes}


# --- boundaries -----------------------------------------------------------------


def prefecture_boundaries(features: DataFrame) -> DataFrame:
    p = F.col("properties")
    return features.select(
        p["prefecture_code"].alias("prefecture_code"), p["prefecture_name"].alias("prefecture_name"),
        "geometry",
    )


def municipality_boundaries(features: DataFrame) -> DataFrame:
    p = F.col("properties")
    return features.select(
        *[p[c].alias(c) for c in ("lg_code", "prefecture_code", "prefecture_name", "county_name", "city_name")],
        "geometry",
    )


# --- property prices -------------------------------------------------------------

# Fixed values: (source field, published column, soft cast) of the price mart.
TRADE_PRICE_SPEC = [
    ("Type", "property_type", None),
    ("Region", "region", None),
    ("MunicipalityCode", "municipality_code", None),
    ("Prefecture", "prefecture", None),
    ("Municipality", "municipality", None),
    ("DistrictName", "district_name", None),
    ("TradePrice", "trade_price", "bigint"),
    ("PricePerUnit", "price_per_unit", "bigint"),
    ("FloorPlan", "floor_plan", None),
    ("Area", "area", "double"),
    ("UnitPrice", "unit_price", "bigint"),
    ("LandShape", "land_shape", None),
    ("Frontage", "frontage", "double"),
    ("TotalFloorArea", "total_floor_area", "double"),
    ("BuildingYear", "building_year", None),
    ("Structure", "structure", None),
    ("Use", "use_type", None),
    ("Purpose", "purpose", None),
    ("Direction", "direction", None),
    ("Classification", "classification", None),
    ("Breadth", "breadth", "double"),
    ("CityPlanning", "city_planning", None),
    ("CoverageRatio", "coverage_ratio", "double"),
    ("FloorAreaRatio", "floor_area_ratio", "double"),
    ("Period", "period", None),
    ("Renovation", "renovation", None),
    ("Remarks", "remarks", None),
    ("PriceCategory", "price_category", None),
    ("DistrictCode", "district_code", None),
    ("_area_code", "prefecture_code", None),
    ("_year", "year", None),
    ("_quarter", "quarter", None),
]


def trade_prices(raw: DataFrame) -> DataFrame:
    return rename_cast(raw, TRADE_PRICE_SPEC)


# --- articles ----------------------------------------------------------------------


def articles(raw: DataFrame) -> DataFrame:
    """Article extract (text date and array columns) → typed rows with search text."""
    typed = raw.select(
        "slug", "title", "description",
        F.col("date").cast("date").alias("date"),
        text_array("datasources").alias("datasources"),
        text_array("tags").alias("tags"),
    )
    return typed.withColumn(
        "search_text", F.concat_ws(" ", "title", "description", F.array_join("tags", " "))
    ).orderBy(F.desc("date"))


def views_by_name(frames: Mapping[str, DataFrame]) -> None:
    """Register each DataFrame as a temp view (views copy no data)."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
