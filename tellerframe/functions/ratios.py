"""Exact division: decimals throughout, half-up, null on a zero divisor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(28,4)"
_DIVISOR = "decimal(20,2)"


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """``numerator / denominator`` rounded half up; a zero divisor gives null.

    A DECIMAL(28,4) over a DECIMAL(20,2) keeps 12 fractional digits
    in the quotient, so the rounding below sees the true value.
    """
    return F.round(F.try_divide(numerator.cast(_WIDE), denominator.cast(_DIVISOR)), digits)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole``."""
    return ratio(part.cast(_WIDE) * 100, whole, digits)


def mean(value: Column, digits: int) -> Column:
    """Average over non-null values, rounded once from the exact sum."""
    return ratio(F.sum(value), F.count(value), digits)


def share_true(flag: Column, digits: int = 2) -> Column:
    """Percent of all rows for which the flag holds."""
    return percent(F.count_if(flag), F.count(F.lit(1)), digits)
