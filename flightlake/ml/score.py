"""Batch delay-risk scoring of scheduled flights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.contracts import (
    CARRIER_WEIGHT,
    COST_PER_DELAY_MINUTE_USD,
    DISTANCE_MULTIPLIERS,
    FIRST_HOUR,
    HEURISTIC_WEIGHT,
    HOUR_MULTIPLIERS,
    MODEL_WEIGHT,
    PROBABILITY_CEILING,
    PROBABILITY_FLOOR,
    RISK_HIGH_FROM,
    RISK_MODERATE_FROM,
    ROUTE_WEIGHT,
    SCORE_DEFAULT_DELAY,
    SCORE_DEFAULT_RATE,
    WEEKDAY_MULTIPLIERS,
    WEEKEND_MULTIPLIER,
)
from flightlake.functions.metrics import rounded
from flightlake.ml.boosting import Ensemble
from flightlake.ml.features import FittedStats, add_features
from flightlake.ml.models import predict, top_drivers


def _table(values: list[float], first: int, index: Column) -> Column:
    """Value of a fixed table at `index`, clamped to its ends."""
    last = first + len(values) - 1
    place = F.greatest(F.lit(first), F.least(index, F.lit(last))) - first + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), place.cast("int"))


def multipliers(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "hour_multiplier": _table(
                HOUR_MULTIPLIERS, FIRST_HOUR, F.col("scheduled_departure_hour")
            ),
            "weekday_multiplier": _table(WEEKDAY_MULTIPLIERS, 1, F.col("day_of_week")),
            "distance_multiplier": _table(DISTANCE_MULTIPLIERS, 1, F.col("distance_group")),
            "weekend_multiplier": F.when(F.col("is_weekend"), WEEKEND_MULTIPLIER).otherwise(1.0),
        }
    )


def risk_level(probability: Column) -> Column:
    return (
        F.when(probability < RISK_MODERATE_FROM, "low")
        .when(probability < RISK_HIGH_FROM, "moderate")
        .otherwise("high")
    )


def _with_baselines(rows: DataFrame, stats: FittedStats) -> DataFrame:
    """Route baseline and carrier ratios; unknown routes and carriers count as average."""
    rate = SCORE_DEFAULT_RATE if stats.global_rate is None else stats.global_rate
    delay = SCORE_DEFAULT_DELAY if stats.global_delay is None else stats.global_delay
    routes = stats.routes.select(
        "route_code",
        F.col("route_congestion_index").alias("_route_rate"),
        F.col("route_avg_delay_minutes").alias("_route_delay"),
    )
    carriers = stats.carriers.select(
        "reporting_airline_code",
        F.col("carrier_historical_delay_rate").alias("_carrier_rate"),
        F.col("carrier_avg_delay_minutes").alias("_carrier_delay"),
    )

    def against(value: str, average: float) -> Column:
        return F.coalesce(F.col(value), F.lit(average)) / average if average > 0 else F.lit(1.0)

    return (
        rows.join(routes, "route_code", "left")
        .join(carriers, "reporting_airline_code", "left")
        .withColumns(
            {
                "base_rate": F.coalesce("_route_rate", F.lit(rate)),
                "base_delay": F.coalesce("_route_delay", F.lit(delay)),
                "carrier_rate_ratio": against("_carrier_rate", rate),
                "carrier_delay_ratio": against("_carrier_delay", delay),
            }
        )
        .drop("_route_rate", "_route_delay", "_carrier_rate", "_carrier_delay")
    )


def score(
    rows: DataFrame, stats: FittedStats, classifier: Ensemble | None = None
) -> DataFrame:
    """Add unrounded `delay_probability` and `estimated_delay_minutes` to each flight.

    Without a classifier the score rests on the fitted statistics alone.
    """
    if classifier is not None:
        featured = add_features(rows, stats)
        scored = predict(classifier, featured, "_model_probability")
        rows = scored.select(*rows.columns, "_model_probability")
    based = multipliers(_with_baselines(rows, stats))
    timing = (
        F.col("hour_multiplier") * F.col("weekday_multiplier") * F.col("weekend_multiplier")
    )

    def blended(base: str, against: str) -> Column:
        return (
            F.col(base) * ROUTE_WEIGHT + F.col(base) * F.col(against) * CARRIER_WEIGHT
        ) * timing

    rate = blended("base_rate", "carrier_rate_ratio")
    if classifier is not None:
        rate = HEURISTIC_WEIGHT * rate + MODEL_WEIGHT * F.col("_model_probability")
    minutes = blended("base_delay", "carrier_delay_ratio") * F.col("distance_multiplier")
    return based.withColumns(
        {
            "delay_probability": F.greatest(
                F.lit(PROBABILITY_FLOOR), F.least(rate, F.lit(PROBABILITY_CEILING))
            ),
            "estimated_delay_minutes": F.greatest(F.lit(0.0), minutes),
        }
    )


def score_report(scored: DataFrame, keep: list[str]) -> DataFrame:
    """Rounded outputs: probability, minutes, tier, cost and factor breakdown."""
    p, minutes = F.col("delay_probability"), F.col("estimated_delay_minutes")
    base = F.col("base_rate")
    return scored.select(
        *keep,
        rounded(p, 4).alias("delay_probability"),
        rounded(p * 100, 1).alias("delay_probability_pct"),
        rounded(minutes, 1).alias("estimated_delay_minutes"),
        risk_level(p).alias("risk_level"),
        rounded(minutes * COST_PER_DELAY_MINUTE_USD).alias("cost_impact_usd"),
        rounded(F.col("base_delay"), 1).alias("route_baseline_delay_min"),
        rounded((F.col("carrier_rate_ratio") - 1.0) * base * CARRIER_WEIGHT * 100, 1).alias(
            "carrier_delta_pct"
        ),
        rounded((F.col("hour_multiplier") - 1.0) * base * 100, 1).alias("hour_delta_pct"),
        rounded((F.col("weekday_multiplier") - 1.0) * base * 100, 1).alias("dow_delta_pct"),
        rounded(F.col("hour_multiplier")).alias("hour_multiplier"),
        rounded(F.col("weekday_multiplier")).alias("dow_multiplier"),
        interpretation(p, minutes).alias("interpretation"),
    )


def with_drivers(report: DataFrame, importance: DataFrame | None, n: int = 4) -> DataFrame:
    """The report with `top_delay_drivers`, the most important features of the model behind it.

    Without an importance table (or with an empty one) the fixed fallback list stands in.
    """
    found = [
        F.struct(F.lit(row["feature"]).alias("feature"), F.lit(round(row["importance"], 4)).alias("importance"))
        for row in top_drivers(importance, report.sparkSession, n).collect()  # n rows
    ]
    return report.withColumn("top_delay_drivers", F.array(*found))


# Sentence per risk tier; {p} percent and {m} minutes without decimals.
SENTENCES = {
    "low": (
        "This flight has a {p}% on-time risk -- well within normal operating parameters. "
        "Expected delay: ~{m} min."
    ),
    "moderate": (
        "Moderate delay risk ({p}%). Operations should monitor gate turnaround times. "
        "Expected delay: ~{m} min."
    ),
    "high": (
        "High delay risk ({p}%). Recommend proactive passenger rebooking and gate buffer "
        "allocation. Expected delay: ~{m} min."
    ),
}


def interpretation(probability: Column, minutes: Column) -> Column:
    """The sentence of the tier with both numbers rounded half to even."""
    shown = {
        "p": F.bround(probability * 100, 0).cast("int").cast("string"),
        "m": F.bround(minutes, 0).cast("int").cast("string"),
    }

    def sentence(tier: str) -> Column:
        text = F.lit(SENTENCES[tier])
        for mark, value in shown.items():
            text = F.replace(text, F.lit("{" + mark + "}"), value)
        return text

    tier = risk_level(probability)
    return (
        F.when(tier == "low", sentence("low"))
        .when(tier == "moderate", sentence("moderate"))
        .otherwise(sentence("high"))
    )
