"""Metric grammar used by every report: conditional counts, safe shares, rounding.

Rounding goes through DECIMAL so that half-way values round away from zero
regardless of their binary form.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, digits: int = 2) -> Column:
    """Decimal rounding for rates, averages and per-row values (below 1e12)."""
    return F.round(value.cast("decimal(18,6)"), digits).cast("double")


def rounded_total(value: Column, digits: int = 2) -> Column:
    """Decimal rounding for grand totals, wide enough for sums over any table."""
    return F.round(value.cast("decimal(38,6)"), digits).cast("double")


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double; null when whole is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def share(part: Column, whole: Column) -> Column:
    """100 * part / whole rounded to 2; null when whole is zero."""
    return rounded(100.0 * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)))


def mean(name: str) -> Column:
    return F.avg(F.col(name).cast("double"))


def total(name: str) -> Column:
    return F.sum(F.col(name).cast("double"))


def median(value: Column, weight: Column | None = None) -> Column:
    """Exact interpolated median; with `weight`, of a value/count histogram."""
    if weight is None:
        return F.percentile(value, 0.5)
    return F.percentile(value, 0.5, weight)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def is_true(condition: Column) -> Column:
    """Three-valued condition where unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def not_false(condition: Column) -> Column:
    """Three-valued condition where unknown counts as true."""
    return F.coalesce(condition, F.lit(True))
