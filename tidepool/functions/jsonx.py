"""JSON-text helpers (nested parts are kept as JSON text, per the lake format)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_text(c: str | Column, path: str) -> Column:
    """Scalar at a JSON path as text (``x->>'$.name'``); missing → NULL."""
    return F.get_json_object(_col(c), path)


def polymorphic_text(c: str | Column) -> Column:
    """A field that is either text or an object ``{"$": text, ...}`` → text.

    ``c`` holds the JSON text of the field value. Objects without ``$``
    fall back to their JSON text.
    """
    x = _col(c)
    is_object = F.trim(x).startswith("{")
    return F.when(is_object, F.coalesce(F.get_json_object(x, "$['$']"), x)).otherwise(
        F.get_json_object(x, "$")
    )


def polymorphic_code(c: str | Column) -> Column:
    """``@code`` of an object-shaped field; text-shaped fields give ``''``."""
    x = _col(c)
    is_object = F.trim(x).startswith("{")
    return F.when(is_object, F.coalesce(F.get_json_object(x, "$['@code']"), F.lit(""))).otherwise(
        F.lit("")
    )


def as_json_list(c: str | Column) -> Column:
    """JSON text holding one object or a list of them → array of element JSON texts."""
    x = _col(c)
    return F.when(x.isNull(), F.array().cast("array<string>")).when(
        F.json_array_length(x).isNull(), F.array(x)
    ).otherwise(F.from_json(x, "array<string>"))
