"""HHMM times, hour blocks and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hhmm_hour(value: Column) -> Column:
    """Hour 0-23 of a numeric HHMM time; 2400 is midnight; anything else is null."""
    hour = F.floor(value / 100)
    valid = hour.between(0, 23) & (value - hour * 100).between(0, 59)
    return F.when(valid, hour).when(value == 2400, 0).cast("int")


def hour_block(hour: Column) -> Column:
    """`HH00-HH59` label; null for a null hour."""
    two = F.lpad(hour.cast("string"), 2, "0")
    return F.concat(two, F.lit("00-"), two, F.lit("59"))


def iso_weekday(day: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.weekday(day) + 1).cast("int")


def calendar(day: Column) -> dict[str, Column]:
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": iso_weekday(day),
    }


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def date_key(day: Column) -> Column:
    """Smart integer key yyyyMMdd."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")
