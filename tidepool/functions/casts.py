"""Soft casts of source text, matching the lake engine's TRY_CAST rules.

Spark's ``try_cast('12.5' AS bigint)`` is NULL while the publishing
engine rounds half away from zero (``12.5`` → 13, ``-12.5`` → -13,
``1e3`` → 1000). A plain decimal is rounded once, from its first decimal.
Spark also accepts ``'1d'``/``'1f'`` suffixes as doubles, so the double
cast is guarded by a plain numeric pattern.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the numeric text shapes accepted by the soft double cast.
NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Plain decimal text with more than one decimal: what rounding does not look at.
_LATER_DECIMALS = r"^(\s*[+-]?\d*\.\d)\d+(\s*)$"


def soft_bigint(c: str | Column) -> Column:
    """Text → bigint, rounding decimals half away from zero; junk → NULL."""
    first = F.regexp_replace(_col(c), _LATER_DECIMALS, "$1$2")
    return F.round(first.try_cast("decimal(38,10)"), 0).try_cast("bigint")


def soft_double(c: str | Column) -> Column:
    """Text → double for plain numeric text; anything else → NULL."""
    x = _col(c)
    return F.when(x.rlike(NUMERIC_TEXT), x.try_cast("double"))


def text_date(c: str | Column) -> Column:
    """``'YYYY-MM-DD'`` text → date (NULL stays NULL, junk raises under ANSI)."""
    return _col(c).cast("date")


# One item of a bare list and the comma behind it: a quoted text, or a run without commas.
_ITEM = r"""(\s*"[^"]*"\s*|\s*'[^']*'\s*|[^,]*),"""


def _bare_list(inner: Column) -> Column:
    """Items of a bare ``a, "b, c", 'd', NULL`` list: trimmed, one layer of
    quotes removed, unquoted NULL → NULL. One pass, no look-around: lists of
    any length."""

    def item(e: Column) -> Column:
        t = F.trim(e)
        quoted = (F.length(t) >= 2) & (
            (t.startswith('"') & t.endswith('"')) | (t.startswith("'") & t.endswith("'"))
        )
        unquoted = F.when(quoted, F.substring(t, F.lit(2), F.length(t) - F.lit(2))).otherwise(t)
        return F.when(F.upper(t) == "NULL", F.lit(None).cast("string")).otherwise(unquoted)

    # a comma is put behind the last item, so every item ends with one
    closed = F.concat(inner, F.lit(","))
    quotes = F.contains(inner, F.lit('"')) | F.contains(inner, F.lit("'"))
    items = F.when(quotes, F.regexp_extract_all(closed, F.lit(_ITEM), F.lit(1))).otherwise(F.split(inner, ","))
    return F.when(F.trim(inner) == "", F.array().cast("array<string>")).otherwise(F.transform(items, item))


def text_array(c: str | Column) -> Column:
    """Array text → array<string>, like the lake engine's ``VARCHAR[]`` cast.

    Lists of plain items — bare (``'[a, "b, c", NULL]'``) or JSON strings
    without escapes (``'["a","b"]'``) — are split on commas outside quotes,
    items trimmed, unquoted, and unquoted NULL/null made NULL; this needs no
    JSON parser. Text with escapes or nested brackets (``'[[1,2],[3]]'``)
    goes through ``from_json``. ``'[]'`` gives an empty array; NULL, or text
    that is not bracketed, gives NULL.
    """
    x = F.trim(_col(c))
    bracketed = x.startswith("[") & x.endswith("]")
    inner = F.substring(x, F.lit(2), F.length(x) - F.lit(2))
    needs_json = F.contains(inner, F.lit("\\")) | F.contains(inner, F.lit("[")) | F.contains(inner, F.lit("{"))
    bare = _bare_list(inner)
    return F.when(bracketed & needs_json, F.coalesce(F.from_json(x, "array<string>"), bare)).when(bracketed, bare)
