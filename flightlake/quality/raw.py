"""Quality suite of the raw 48-column layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.contracts import DELAY_THRESHOLD_MINUTES, RAW_COLUMNS, RAW_KEY, RAW_NON_NEGATIVE
from flightlake.functions import casts, times
from flightlake.functions.metrics import any_of
from flightlake.operators.duplicates import duplicate_counts
from flightlake.operators.standard import missing_columns
from flightlake.quality.rules import Rule, combine, count_rules, fixed_rule, run_rules

_NUMERIC = [
    "YEAR", "QUARTER", "MONTH", "DAY_OF_MONTH", "DAY_OF_WEEK", "CANCELLED", "DIVERTED",
    "DEP_DEL15", "ARR_DEL15", *RAW_NON_NEGATIVE,
]
_PRESENT = ["OP_UNIQUE_CARRIER", "ORIGIN", "DEST", "CRS_DEP_TIME", "CRS_ARR_TIME", "FLIGHTS", "DISTANCE"]
_CALENDAR = {
    "year": "YEAR",
    "quarter": "QUARTER",
    "month": "MONTH",
    "day_of_month": "DAY_OF_MONTH",
    "day_of_week": "DAY_OF_WEEK",
}


def _n(name: str) -> Column:
    """The numeric reading of a raw column, parsed once below the rules."""
    return F.col(f"n_{name}")


def _row_rules(year: int, month: int) -> list[Rule]:
    day = F.col("day")
    parts = times.calendar(day)
    cancelled, diverted = _n("CANCELLED"), _n("DIVERTED")
    code = F.col("CANCELLATION_CODE")
    rules = [Rule("valid_flight_dates", day.isNull(), "The flight date can be read.")]
    for part, label in {
        "year": "year", "quarter": "quarter", "month": "month",
        "day_of_month": "day", "day_of_week": "weekday",
    }.items():
        differs = day.isNotNull() & ~parts[part].cast("double").eqNullSafe(_n(_CALENDAR[part]))
        rules.append(
            Rule(f"{label}_matches_flight_date", differs, f"The source {label} fits the date.")
        )
    in_period = (_n("YEAR") == year) & (_n("MONTH") == month)
    rules += [
        Rule(
            "selected_period",
            ~F.coalesce(in_period, F.lit(False)),
            f"All rows belong to {year}-{month:02d}.",
        ),
        Rule(
            "flight_key_not_missing",
            any_of([F.col(c).isNull() for c in RAW_KEY]),
            "No part of the flight key is missing.",
        ),
    ]
    for column in ("CANCELLED", "DIVERTED"):
        rules.append(
            Rule(
                f"valid_{column.lower()}_indicator",
                ~F.coalesce(_n(column).isin(0.0, 1.0), F.lit(False)),
                f"{column} is 0 or 1.",
            )
        )
    rules.append(
        Rule(
            "flight_not_cancelled_and_diverted",
            (cancelled == 1) & (diverted == 1),
            "A flight is not both cancelled and diverted.",
        )
    )
    for column in _PRESENT:
        rules.append(
            Rule(f"{column.lower()}_not_missing", F.col(column).isNull(), f"{column} is present.")
        )
    rules.append(
        Rule(
            "non_negative_measurements",
            any_of([F.coalesce(_n(c) < 0, F.lit(False)) for c in RAW_NON_NEGATIVE]),
            "No unsigned measurement is negative.",
        )
    )
    for side, value, flag in (
        ("departure", "DEP_DELAY_NEW", "DEP_DEL15"),
        ("arrival", "ARR_DELAY_NEW", "ARR_DEL15"),
    ):
        late = (_n(value) >= DELAY_THRESHOLD_MINUTES).cast("double")
        rules.append(
            Rule(
                f"{side}_delay_indicator_consistent",
                late != _n(flag),
                f"{flag} agrees with {value} where both are known.",
            )
        )
    rules += [
        Rule(
            "cancelled_flights_have_reason",
            (cancelled == 1) & code.isNull(),
            "Cancelled flights carry a reason code.",
            "warning",
        ),
        Rule(
            "active_flights_have_no_cancellation_code",
            (cancelled == 0) & code.isNotNull(),
            "Other flights carry no reason code.",
            "warning",
        ),
        Rule(
            "origin_differs_from_destination",
            F.col("ORIGIN_AIRPORT_ID") == F.col("DEST_AIRPORT_ID"),
            "Origin and destination differ.",
            "warning",
        ),
    ]
    return rules


def validate_raw(raw: DataFrame, year: int = 2024, month: int = 1) -> DataFrame:
    """27 rules as (rule_name, severity, status, failed_row_count, description)."""
    missing = missing_columns(raw, RAW_COLUMNS)
    presence = fixed_rule(
        raw.sparkSession,
        "required_columns_present",
        len(missing),
        f"All source columns are present. Missing: {missing}",
    )
    if missing:
        return presence
    rows = raw.select(
        casts.flight_date(raw, "FL_DATE").alias("day"),
        *[casts.number(raw, c).alias(f"n_{c}") for c in _NUMERIC],
        *dict.fromkeys([*RAW_KEY, *_PRESENT, "CANCELLATION_CODE"]),
    )
    duplicates = count_rules(
        duplicate_counts(raw.select(*RAW_COLUMNS), RAW_KEY),
        {
            "no_exact_duplicate_rows": ("exact_duplicates", "No row repeats in every column."),
            "unique_flight_keys": ("duplicate_key_rows", "Every flight key occurs once."),
        },
    )
    return combine([presence, run_rules(rows, _row_rules(year, month)), duplicates])
