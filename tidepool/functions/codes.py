"""Code columns: zero padding and the modulus-11 check digit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the five code digits in the modulus-11 check
# digit of local-government codes (first digit weighs 6, last weighs 2).
CHECK_DIGIT_WEIGHTS = (6, 5, 4, 3, 2)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero_pad(c: str | Column, width: int) -> Column:
    """Number or text → text left-padded with zeros (``1`` → ``"01"``)."""
    return F.lpad(_col(c).cast("string"), width, "0")


def check_digit(code5: str | Column) -> Column:
    """Modulus-11 check digit of a 5-digit text code, as text.

    remainder 0 → 1, remainder 1 → 0, otherwise 11 - remainder.
    """
    code = _col(code5)
    total = None
    for pos, weight in enumerate(CHECK_DIGIT_WEIGHTS, start=1):
        term = F.substring(code, pos, 1).cast("int") * F.lit(weight)
        total = term if total is None else total + term
    rem = total % F.lit(11)
    digit = F.when(rem == 0, F.lit(1)).when(rem == 1, F.lit(0)).otherwise(F.lit(11) - rem)
    return digit.cast("string")


def with_check_digit(code5: str | Column) -> Column:
    """5-digit code with its check digit appended (6 digits)."""
    return F.concat(_col(code5), check_digit(code5))
