"""Statistics fact tables → category views and the item catalogue.

A fact table carries codes (category, area, time) plus JSON metadata
objects whose ``name`` labels the code. A category view keeps one code
prefix (pushed to the scan as ``StringStartsWith``) and labels the codes;
the item catalogue lists the distinct labelled category codes.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.jsonx import json_text


def category_view(
    facts: DataFrame,
    code_col: str,
    keep: list[str],
    labels: Mapping[str, tuple[str, str]],
    prefix: str | None = None,
) -> DataFrame:
    """Select ``keep`` columns plus labels ``{out: (json_col, path)}``.

    With ``prefix`` only rows whose ``code_col`` starts with it remain.
    """
    df = facts
    if prefix is not None:
        df = df.where(F.col(code_col).startswith(prefix))
    cols = [F.col(c) for c in keep]
    cols += [json_text(src, path).alias(out) for out, (src, path) in labels.items()]
    return df.select(*cols)


def item_catalogue(
    facts: DataFrame, code_col: str, label_col: str, prefix_len: int = 1,
    label_path: str | None = None,
) -> DataFrame:
    """Distinct (code prefix, code, label), ordered by code."""
    label = json_text(label_col, label_path) if label_path else F.col(label_col)
    return (
        facts.select(
            F.left(F.col(code_col), F.lit(prefix_len)).alias("category_prefix"),
            F.col(code_col).alias(code_col),
            label.alias("item_name"),
        )
        .distinct()
        .orderBy(code_col, "item_name")
    )
