"""Quality suite of the clean table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.contracts import (
    CAUSE_COLUMNS,
    CLEAN_KEY,
    CLEAN_NON_NEGATIVE,
    CLEAN_SUITE_EXTRA,
    STATUSES,
    WAREHOUSE_REQUIRED,
)
from flightlake.functions import times
from flightlake.functions.metrics import any_of, not_false
from flightlake.operators.duplicates import repeated_keys
from flightlake.operators.standard import flight_status, missing_columns, on_time
from flightlake.quality.rules import Rule, combine, count_rules, fixed_rule, run_rules


def _row_rules(year: int, month: int) -> list[Rule]:
    day, status = F.col("flight_date"), F.col("flight_status")
    parts = times.calendar(day)
    expected_status = flight_status(F.col("cancelled"), F.col("diverted"))
    route = F.concat("origin_airport_code", F.lit("-"), "destination_airport_code")
    causes = sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in CAUSE_COLUMNS), F.lit(0.0))
    total = F.col("total_reported_delay_minutes").cast("double")
    rules = [
        Rule(
            "flight_key_not_missing",
            any_of([F.col(c).isNull() for c in CLEAN_KEY]),
            "No part of the flight key is missing.",
        ),
        Rule(
            "warehouse_required_values_not_missing",
            any_of([F.col(c).isNull() for c in WAREHOUSE_REQUIRED]),
            "All columns that the warehouse requires are filled.",
        ),
        Rule(
            "date_period",
            not_false((F.year(day) != year) | (F.month(day) != month)),
            f"All rows belong to {year}-{month:02d}.",
        ),
        # an unknown calendar field is not a mismatch here
        Rule(
            "calendar_fields_match_flight_date",
            any_of([F.coalesce(F.col(n) != part, F.lit(False)) for n, part in parts.items()]),
            "Calendar fields fit the flight date.",
        ),
        Rule(
            "flight_status_is_valid",
            ~F.coalesce(status.isin(*STATUSES), F.lit(False)),
            "The status is one of the three known values.",
        ),
        Rule(
            "flight_not_cancelled_and_diverted",
            (F.col("cancelled") == 1) & (F.col("diverted") == 1),
            "A flight is not both cancelled and diverted.",
        ),
        Rule(
            "flight_status_matches_indicators",
            status != expected_status,
            "The status agrees with its two flags.",
        ),
        Rule(
            "route_code_is_consistent",
            F.col("route_code") != route,
            "The route joins both airport codes.",
        ),
        Rule(
            "weekend_indicator_is_consistent",
            F.col("is_weekend") != times.is_weekend(day),
            "The weekend flag follows the date.",
        ),
    ]
    for side in ("departure", "arrival"):
        hour = times.hhmm_hour(F.col(f"scheduled_{side}_time"))
        # here an unknown hour is a failure
        rules.append(
            Rule(
                f"scheduled_{side}_hour_is_valid",
                not_false(F.col(f"scheduled_{side}_hour") != hour),
                f"The scheduled {side} hour follows a valid HHMM time.",
            )
        )
    rules += [
        Rule(
            "measurements_are_non_negative",
            any_of([F.coalesce(F.col(c) < 0, F.lit(False)) for c in CLEAN_NON_NEGATIVE]),
            "No unsigned measurement is negative.",
        ),
        Rule(
            "total_reported_delay_is_consistent",
            F.abs(total - causes) > 0.01,
            "The total is the sum of the five causes.",
        ),
        Rule(
            "arrival_on_time_is_consistent",
            ~F.col("arrival_on_time").eqNullSafe(on_time(status, F.col("arrival_delayed_15"))),
            "The on-time flag follows status and delay flag.",
        ),
    ]
    return rules


def validate_clean(clean: DataFrame, year: int = 2024, month: int = 1) -> DataFrame:
    """17 rules as (rule_name, severity, status, failed_row_count, description)."""
    missing = missing_columns(clean, [*WAREHOUSE_REQUIRED, *CLEAN_SUITE_EXTRA])
    presence = fixed_rule(
        clean.sparkSession,
        "required_columns_present",
        len(missing),
        f"All required clean columns are present. Missing: {missing}",
    )
    if missing:
        return presence
    filled = count_rules(
        clean.agg((F.count(F.lit(1)) == 0).cast("bigint").alias("empty")),
        {"dataset_is_not_empty": ("empty", "The table has rows.")},
    )
    unique = count_rules(
        repeated_keys(clean, CLEAN_KEY).agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("duplicate_key_rows")
        ),
        {"flight_key_is_unique": ("duplicate_key_rows", "Every flight key occurs once.")},
    )
    return combine([presence, filled, run_rules(clean, _row_rules(year, month)), unique])
