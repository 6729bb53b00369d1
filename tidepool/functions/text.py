"""Text-producing expressions: ids, search text, SQL literals, sizes, classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def path_key(*parts: str | Column, sep: str = "/") -> Column:
    """``a/b/c`` ids; any NULL part makes the id NULL (like ``||``)."""
    cols: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(_col(p))
    return F.concat(*cols)


def underscore_words(c: str | Column) -> Column:
    """``snake_name`` → ``snake name`` for search text."""
    return F.replace(_col(c), F.lit("_"), F.lit(" "))


def _size_text(size: Column, unit_bytes: int, unit: str) -> Column:
    # size / unit rounded to one decimal, ties to even on the exact value
    # (matches printf-style formatting of the exact binary quotient).
    x = size * F.lit(10)
    q = F.floor(x / F.lit(unit_bytes)).cast("bigint")
    r = x - q * F.lit(unit_bytes)
    twice = r * F.lit(2)
    up = (twice > F.lit(unit_bytes)) | ((twice == F.lit(unit_bytes)) & (q % 2 == 1))
    tenths = q + F.when(up, F.lit(1)).otherwise(F.lit(0))
    return F.concat(
        F.floor(tenths / 10).cast("bigint").cast("string"),
        F.lit("."),
        (tenths % 10).cast("string"),
        F.lit(" " + unit),
    )


def human_size(c: str | Column) -> Column:
    """Bytes → ``'N B'``, ``'x.y KB'``, ``'x.y MB'`` or ``'x.y GB'``."""
    size = _col(c).cast("bigint")
    kb, mb, gb = 1024, 1024 * 1024, 1024 * 1024 * 1024
    return (
        F.when(size < kb, F.concat(size.cast("string"), F.lit(" B")))
        .when(size < mb, _size_text(size, kb, "KB"))
        .when(size < gb, _size_text(size, mb, "MB"))
        .otherwise(_size_text(size, gb, "GB"))
    )


def sql_value_expr(x: str) -> str:
    """Spark SQL text of :func:`sql_value` for the SQL expression ``x``."""
    return (
        f"CASE WHEN ({x}) IS NULL THEN 'NULL' ELSE "
        f"concat(chr(39), replace(CAST(({x}) AS STRING), chr(39), repeat(chr(39), 2)), chr(39)) END"
    )


def sql_value(c: str | Column) -> Column:
    """Value → SQL literal text: ``NULL`` or a quoted string with ``'`` doubled.

    A column name is rendered through :func:`sql_value_expr` (one expression
    parsed on the JVM); a Column through the equivalent Column calls."""
    if isinstance(c, str):
        return F.expr(sql_value_expr(f"`{c}`"))
    x = c.cast("string")
    return F.when(x.isNull(), F.lit("NULL")).otherwise(
        F.concat(F.lit("'"), F.replace(x, F.lit("'"), F.lit("''")), F.lit("'"))
    )


def sql_bool(c: str | Column) -> Column:
    """Boolean → ``'1'`` when true, ``'0'`` otherwise (NULL included)."""
    if isinstance(c, str):
        return F.expr(f"CASE WHEN `{c}` = true THEN '1' ELSE '0' END")
    return F.when(c == F.lit(True), F.lit("1")).otherwise(F.lit("0"))


def json_string_list(c: str | Column) -> Column:
    """array<string> → JSON text with ``", "`` separators (``["a", "b"]``)."""
    arr = _col(c)
    quoted = F.transform(
        arr,
        lambda e: F.when(e.isNull(), F.lit("null")).otherwise(
            F.regexp_extract(F.to_json(F.array(e)), r"^\[(.*)\]$", 1)
        ),
    )
    return F.when(arr.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
    )


def sql_json(c: str | Column) -> Column:
    """array<string> → SQL literal of its JSON text (``NULL`` for NULL)."""
    return sql_value(json_string_list(c))


def classify_keywords(
    text: str | Column,
    tiers: Sequence[tuple[str, Sequence[str]]],
    default: str = "unknown",
) -> Column:
    """First tier whose any keyword occurs in ``text`` names the class."""
    x = _col(text)
    out = None
    for label, words in tiers:
        hit = None
        for w in words:
            cond = F.contains(x, F.lit(w))
            hit = cond if hit is None else (hit | cond)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))
