"""Survey of statistics-table listings: polymorphic fields, keyword
classes, per-survey summaries, axis summaries.

Listing entries arrive as JSON where a field may be text or an object
(``{"$": text, "@code": code}``) and a child may be one object or a list.
All summaries are partial aggregations (``count``, ``min_by``/``max_by``,
``collect_set`` of dates), so a survey holding a large share of the rows
is combined map-side rather than sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.text import classify_keywords
from tidepool.operators.ordering import staged

# Keyword tiers of the small-area survey (mesh first, then
# small area, else unknown).
MESH_WORDS = ["メッシュ"]
SMALL_AREA_WORDS = ["小地域", "町丁", "字等"]
SURVEY_TIERS = [("mesh", MESH_WORDS), ("small_area", SMALL_AREA_WORDS)]
SAMPLE_SIZE = 5


def classify(
    df: DataFrame,
    text_cols: Sequence[str | Column],
    tiers: Sequence[tuple[str, Sequence[str]]] = SURVEY_TIERS,
    out: str = "category",
) -> DataFrame:
    """Add the keyword class of the space-joined ``text_cols``."""
    text = F.concat_ws(" ", *[F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in text_cols])
    return df.withColumn(out, classify_keywords(text, tiers))


def count_per(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def survey_summary(
    df: DataFrame,
    group: str,
    position: str,
    code: str,
    date: str,
    item: str,
    last_n: int = SAMPLE_SIZE,
) -> DataFrame:
    """Per group: size, code of the first entry (by ``position``), number
    and last ``last_n`` of the sorted distinct dates, and the latest entry
    (greatest ``date``; ties → first by ``position``). Largest groups first."""
    dates = F.array_sort(F.collect_set(F.col(date)))
    agg = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.min_by(F.col(code), F.col(position)).alias("first_code"),
        dates.alias("_dates"),
        F.max_by(F.col(item), F.struct(F.col(date), -F.col(position))).alias("latest_item"),
        F.max(F.col(date)).alias("latest_date"),
    )
    n = F.size("_dates")
    return agg.select(
        group,
        "n_items",
        "first_code",
        n.alias("n_dates"),
        F.array_join(F.slice("_dates", F.greatest(n - F.lit(last_n - 1), F.lit(1)), last_n), ",").alias(
            "last_dates"
        ),
        "latest_item",
        "latest_date",
    ).orderBy(F.desc("n_items"), group)


AXIS_SCHEMA = "array<struct<`@id`:string,`@name`:string,CLASS:string>>"
CLASS_SCHEMA = "array<struct<`@code`:string,`@name`:string>>"


def axis_summary(df: DataFrame, keys: Sequence[str], class_inf: str) -> DataFrame:
    """One row per class object (axis) of ``class_inf`` JSON (one object or a
    list): id, name, number of classes, first codes and names.

    A typed ``from_json`` with an array schema reads a single object as a
    one-element array, so each level is parsed once whatever its shape."""
    no_axes = F.array().cast(AXIS_SCHEMA)
    axes = df.select(
        *keys,
        F.posexplode(F.coalesce(F.from_json(class_inf, AXIS_SCHEMA), no_axes)).alias("_axis_pos", "_obj"),
    )
    classes = F.coalesce(F.from_json(F.col("_obj")["CLASS"], CLASS_SCHEMA), F.array().cast(CLASS_SCHEMA))
    return axes.select(
        *keys,
        (F.col("_axis_pos") + 1).cast("int").alias("axis_pos"),
        F.coalesce(F.col("_obj")["@id"], F.lit("")).alias("axis_id"),
        F.coalesce(F.col("_obj")["@name"], F.lit("")).alias("axis_name"),
        classes.alias("_classes"),
    ).select(
        *keys, "axis_pos", "axis_id", "axis_name",
        F.size("_classes").alias("num_classes"),
        F.array_join(F.transform(F.slice("_classes", 1, SAMPLE_SIZE), lambda c: F.coalesce(c["@code"], F.lit(""))), ",").alias("sample_codes"),
        F.array_join(F.transform(F.slice("_classes", 1, SAMPLE_SIZE), lambda c: F.coalesce(c["@name"], F.lit(""))), ",").alias("sample_names"),
    )


def simplify_tables(df: DataFrame, entry_col: str) -> DataFrame:
    """Listing entries (JSON text of one table description, whose TITLE and
    STAT_NAME are text or ``{"$": …, "@code": …}``) → flat rows: id,
    stat_name, stat_code, title, survey_date, statistics_name, small_area,
    collect_area (missing fields become ''). One parse of each entry; a
    field typed as string comes back as plain text for a JSON string and as
    JSON text for an object."""
    fields = F.from_json(
        F.col(entry_col),
        "struct<`@id`:string,TITLE:string,STAT_NAME:string,STATISTICS_NAME:string,SURVEY_DATE:string,"
        "SMALL_AREA:string,COLLECT_AREA:string>",
    )
    e = df.select("*", fields.alias("_e"))
    text = lambda c: F.coalesce(F.col("_e")[c], F.lit(""))

    def is_object(x: Column) -> Column:
        return F.coalesce(F.trim(x).startswith("{"), F.lit(False))

    def label(x: Column) -> Column:
        return F.coalesce(F.when(is_object(x), F.coalesce(F.get_json_object(x, "$['$']"), x)).otherwise(x), F.lit(""))

    def code(x: Column) -> Column:
        return F.when(is_object(x), F.coalesce(F.get_json_object(x, "$['@code']"), F.lit(""))).otherwise(F.lit(""))

    return e.select(
        *[c for c in df.columns if c != entry_col],
        text("@id").alias("id"),
        label(F.col("_e")["STAT_NAME"]).alias("stat_name"),
        code(F.col("_e")["STAT_NAME"]).alias("stat_code"),
        label(F.col("_e")["TITLE"]).alias("title"),
        text("SURVEY_DATE").alias("survey_date"),
        text("STATISTICS_NAME").alias("statistics_name"),
        text("SMALL_AREA").alias("small_area"),
        text("COLLECT_AREA").alias("collect_area"),
    )


def survey_report(entries: DataFrame, entry_col: str, position: str) -> DataFrame:
    """The survey of a table listing in one pass: entries by class, and the groups by
    survey of the class looked for.

    ``entries`` holds one JSON text per listed table (:func:`simplify_tables`) and its
    place in the listing. Rows of section ``class``: the number of entries of each
    class. Rows of section ``survey``: per survey name of the small-area class (of the
    unknown one where no entry is of the small-area class) the number of entries, the
    code of the first, all dates in order, the last ones, and id, title and date of the
    latest entry (ties: the first listed). Both come from one aggregation over the two
    grouping sets; it combines map-side, so a class or survey with most of the entries is
    no bottleneck."""
    rows = classify(simplify_tables(entries, entry_col), ["title", "stat_name", "statistics_name"])
    latest = F.struct(F.col("survey_date"), -F.col(position))
    dates = F.array_sort(F.collect_set("survey_date"))
    grouped = (
        rows.groupingSets([[F.col("category")], [F.col("category"), F.col("stat_name")]], "category", "stat_name")
        .agg(
            F.grouping("stat_name").alias("_all"),
            F.count(F.lit(1)).alias("n_tables"),
            F.min_by("stat_code", position).alias("_code"),
            F.when(F.grouping("stat_name") == 0, dates).alias("_dates"),
            F.max_by(F.struct("id", "title", "survey_date"), latest).alias("_latest"),
        )
    )
    done = staged(grouped, "survey")  # small: one row per class and survey
    looked_for = done.select(
        F.when(F.max(F.col("category") == "small_area"), "small_area").otherwise("unknown")
    ).scalar()
    survey = F.col("_all") == 0
    n = F.size("_dates")
    only = lambda c: F.when(survey, c)
    return done.where(~survey | (F.col("category") == looked_for)).select(
        F.when(survey, "survey").otherwise("class").alias("section"),
        "category",
        only(F.col("stat_name")).alias("survey"),
        "n_tables",
        only(F.col("_code")).alias("stat_code"),
        only(F.array_join("_dates", ",")).alias("dates"),
        only(F.array_join(F.slice("_dates", F.greatest(n - F.lit(SAMPLE_SIZE - 1), F.lit(1)), SAMPLE_SIZE), ",")).alias("last_dates"),
        only(F.col("_latest.id")).alias("latest_id"),
        only(F.col("_latest.title")).alias("latest_title"),
        only(F.col("_latest.survey_date")).alias("latest_date"),
    )
