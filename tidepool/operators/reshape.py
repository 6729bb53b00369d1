"""Reshaping: rename/cast specs, NULL-dropping unpivot, label splitting,
period unions. All are narrow (no shuffle)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.casts import soft_bigint, soft_double, text_date

_CASTS = {
    None: lambda c: c,
    "text": lambda c: c.cast("string"),
    "bigint": soft_bigint,
    "double": soft_double,
    "date": text_date,
    "int": lambda c: soft_bigint(c).cast("int"),
}


def rename_cast(df: DataFrame, spec: Sequence[tuple[str, str, str | None]]) -> DataFrame:
    """Project ``(source, target, cast)`` triples; cast is one of
    None (keep), ``text``, ``bigint``/``int`` (soft, rounding), ``double``
    (soft), ``date``. Missing optional source columns become NULL."""
    present = set(df.columns)
    cols: list[Column] = []
    for src, dst, kind in spec:
        base = F.col(src) if src in present else F.lit(None).cast("string")
        cols.append(_CASTS[kind](base).alias(dst))
    return df.select(*cols)


def unpivot_drop_nulls(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], label: str, value: str
) -> DataFrame:
    """Wide → long like SQL ``UNPIVOT``: one row per non-NULL cell."""
    return df.unpivot(list(ids), list(values), label, value).where(F.col(value).isNotNull())


def label_case(c: str | Column, rules: Sequence[tuple[str, str]], default: str | None = None) -> Column:
    """First ``LIKE`` pattern that matches names the value (``_`` and ``%``
    are wildcards, as in SQL)."""
    x = F.col(c) if isinstance(c, str) else c
    out = None
    for pattern, val in rules:
        cond = x.like(pattern)
        out = F.when(cond, F.lit(val)) if out is None else out.when(cond, F.lit(val))
    return out.otherwise(F.lit(default)) if default is not None else out


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def tag_periods(
    df: DataFrame, period_of: Column, periods: Sequence[int] | None = None, period_col: str = "period"
) -> DataFrame:
    """Union of one slice per period, expressed as one scan: rows tagged with
    their period (same rows as UNION ALL of filtered selects, without reading
    the source once per period). ``periods`` keeps only those listed; without
    it every row that has a period is kept."""
    tagged = df.withColumn(period_col, period_of)
    if periods is None:
        return tagged.where(F.col(period_col).isNotNull())
    return tagged.where(F.col(period_col).isin(list(periods)))


def read_periods(readers: Mapping[int, DataFrame], period_col: str = "period") -> DataFrame:
    """Union of per-period inputs that live in separate files."""
    return union_all(df.withColumn(period_col, F.lit(p)) for p, df in readers.items())
