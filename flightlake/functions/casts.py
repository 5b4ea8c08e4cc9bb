"""Coercing casts over text or already typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.contracts import INTEGER_RANGES

# What a cast may read: a cast that fails costs an exception.  A number begins with a digit, a sign, a dot,
# the I of Infinity or what is trimmed, and only an exponent has a minus further in.  Java accepts
# a type suffix ("12f", "3d") that is not part of a number here, and no number ends in the M of a time.
_NUMBER_LIKE = r"^(?:[0-9]+|[\x00- ]*[-+.iI0-9](?:[^-]*[eEpP]-)?[^-]*(?<![dDfFmM ]) *)$"

_STORED = {"int8": "int", "int16": "int", "int32": "int", "int64": "bigint"}


def trimmed(column: Column) -> Column:
    """Surrounding blanks removed; a blank text becomes null."""
    text = F.btrim(column.cast("string"), F.lit(" \t\n\r\x0b\x0c"))
    return F.when(text != "", text)


def number(df: DataFrame, name: str) -> Column:
    """Numeric value of a column as double; what is not a number becomes null."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("double")
    if not isinstance(kind, T.StringType):
        return F.expr(f"nanvl(CAST(`{name}` AS DOUBLE), CAST(NULL AS DOUBLE))")
    text = F.col(name)
    return F.nanvl(F.when(text.rlike(_NUMBER_LIKE), text).try_cast("double"), F.lit(None).cast("double"))


def as_integer(value: Column, kind: str) -> Column:
    """Integer of the given kind from a numeric column; null when it does not fit."""
    low, high = INTEGER_RANGES[kind]
    fits = value.between(low, high) & (value == F.floor(value))
    return F.when(fits, value).cast(_STORED[kind])


def safe_integer(df: DataFrame, name: str, kind: str = "int32") -> Column:
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.when(F.col(name).between(*INTEGER_RANGES[kind]), F.col(name)).cast(_STORED[kind])
    return as_integer(number(df, name), kind)


def safe_float(df: DataFrame, name: str) -> Column:
    return number(df, name).cast("float")


def flight_date(df: DataFrame, name: str) -> Column:
    """Date from `MM/dd/yyyy hh:mm:ss AM/PM` (padding optional); null when unreadable."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_date(F.col(name), "M/d/yyyy h:mm:ss a")
    return F.col(name).cast("date")


def public_types(df: DataFrame) -> DataFrame:
    """Report types: small integers as INT, floats as DOUBLE."""
    out = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.ByteType, T.ShortType)):
            column = column.cast("int").alias(field.name)
        elif isinstance(field.dataType, T.FloatType):
            column = column.cast("double").alias(field.name)
        out.append(column)
    return df.select(*out)
