"""Fact rows: surrogate keys looked up, flags as booleans, 41 columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.contracts import FACT_BOOLEANS, FACT_COLUMNS
from flightlake.functions import times
from flightlake.functions.metrics import any_of, count_where

LOOKED_UP = ["airline_key", "origin_airport_key", "destination_airport_key"]


def fact_rows(
    clean: DataFrame,
    airlines: DataFrame,
    airports: DataFrame,
    extra: list[str] | None = None,
    enforce: bool = False,
) -> DataFrame:
    """Clean rows with their surrogate keys.

    Dimensions are joined without a hint: read back from files they have a known
    size, so Spark broadcasts them while they are small and shuffles otherwise.
    """
    carrier = airlines.select(
        F.col("reporting_airline_id"), F.col("airline_key").alias("_airline_key")
    )
    sides = {
        side: airports.select(
            F.col("airport_id").alias(f"{side}_airport_id"),
            F.col("airport_key").alias(f"_{side}_key"),
        )
        for side in ("origin", "destination")
    }
    keyed = (
        clean.join(carrier, "reporting_airline_id", "left")
        .join(sides["origin"], "origin_airport_id", "left")
        .join(sides["destination"], "destination_airport_id", "left")
    )
    values = {
        "date_key": times.date_key(F.col("flight_date")),
        "airline_key": F.col("_airline_key"),
        "origin_airport_key": F.col("_origin_key"),
        "destination_airport_key": F.col("_destination_key"),
        **{name: F.col(name).cast("boolean") for name in FACT_BOOLEANS},
    }
    facts = keyed.select(
        *(extra or []), *[values.get(c, F.col(c)).alias(c) for c in FACT_COLUMNS]
    )
    if enforce:
        require_matched(facts)
    return facts


def unmatched() -> Column:
    """How many fact rows lack a dimension row, to be counted while they are written."""
    return count_where(any_of([F.col(c).isNull() for c in LOOKED_UP]))


def stop_on_unmatched(rows: int) -> None:
    if rows:
        raise ValueError(f"{rows:,} fact rows refer to an airline or airport that has no dimension row")


def require_matched(facts: DataFrame) -> None:
    """Raise when a fact row has no dimension row (reads the key columns only)."""
    stop_on_unmatched(facts.agg(unmatched()).first()[0])
