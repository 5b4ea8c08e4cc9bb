"""Modelling rows, out-of-time split, fitted statistics, feature columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.contracts import (
    FEATURE_COLUMNS,
    FEATURE_DEFAULT_DELAY,
    FEATURE_DEFAULT_RATE,
    FEATURE_FILL,
    ROUTE_SHRINKAGE,
    TEST_FIRST_DAY,
    TRAIN_LAST_DAY,
)
from flightlake.functions.metrics import ratio
from flightlake.session import staged

TARGET_FLAG, TARGET_MINUTES = "arrival_delayed_15", "arrival_delay_minutes"


def population(clean: DataFrame) -> DataFrame:
    """Completed flights whose outcome is known."""
    known = (
        (F.col("flight_status") == "Completed")
        & F.col(TARGET_MINUTES).isNotNull()
        & F.col(TARGET_FLAG).isNotNull()
    )
    return clean.filter(known).withColumns(
        {
            TARGET_FLAG: F.col(TARGET_FLAG).cast("int"),
            TARGET_MINUTES: F.col(TARGET_MINUTES).cast("double"),
        }
    )


def train_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("day_of_month") <= TRAIN_LAST_DAY)


def test_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("day_of_month") >= TEST_FIRST_DAY)


@dataclass(frozen=True)
class FittedStats:
    """Statistics of the training rows: two small tables and four numbers."""

    carriers: DataFrame  # reporting_airline_code, carrier_historical_delay_rate, ...
    routes: DataFrame  # route_code, route_congestion_index, route_avg_delay_minutes
    totals: DataFrame  # one row: flights, global_delay_rate, global_avg_delay
    global_rate: float | None
    global_delay: float | None


def _sums(df: DataFrame, *keys: str) -> DataFrame:
    columns = ["flag_sum", "flag_n", "delay_sum", "delay_n"]
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in columns])


def _rate():
    return ratio(F.col("flag_sum"), F.col("flag_n"))


def _delay():
    return ratio(F.col("delay_sum"), F.col("delay_n"))


def fit_stats(train: DataFrame) -> FittedStats:
    """Fit carrier, route and global statistics in one scan.

    Rows are reduced to sums per (route, carrier) once and written; all levels
    roll up from that table, which is as large as the flight network.
    """
    rows = train.filter(F.col("flight_status") == "Completed")
    pairs = staged(
        rows.groupBy("route_code", "reporting_airline_code").agg(
            F.sum(F.col(TARGET_FLAG).cast("double")).alias("flag_sum"),
            F.count(TARGET_FLAG).alias("flag_n"),
            F.sum(F.col(TARGET_MINUTES).cast("double")).alias("delay_sum"),
            F.count(TARGET_MINUTES).alias("delay_n"),
        ),
        "stat_pairs",
    )
    totals = staged(
        _sums(pairs).select(
            F.col("flag_n").alias("flights"),
            _rate().alias("global_delay_rate"),
            _delay().alias("global_avg_delay"),
        ),
        "stat_totals",
    )
    overall = totals.first()
    global_rate = overall["global_delay_rate"]
    prior = FEATURE_DEFAULT_RATE if global_rate is None else global_rate
    carriers = _sums(pairs, "reporting_airline_code").select(
        "reporting_airline_code",
        F.col("flag_n").alias("carrier_flights"),
        _rate().alias("carrier_historical_delay_rate"),
        _delay().alias("carrier_avg_delay_minutes"),
    )
    smoothed = (_rate() * F.col("flag_n") + prior * ROUTE_SHRINKAGE) / (
        F.col("flag_n") + ROUTE_SHRINKAGE
    )
    routes = _sums(pairs, "route_code").select(
        "route_code",
        F.col("flag_n").alias("route_flights"),
        smoothed.alias("route_congestion_index"),
        _delay().alias("route_avg_delay_minutes"),
    )
    return FittedStats(
        staged(carriers, "stat_carriers"),
        staged(routes, "stat_routes"),
        totals,
        global_rate,
        overall["global_avg_delay"],
    )


def save_stats(stats: FittedStats, path: str, mode: str = "overwrite") -> None:
    stats.carriers.write.mode(mode).parquet(f"{path}/carriers")
    stats.routes.write.mode(mode).parquet(f"{path}/routes")
    stats.totals.write.mode(mode).parquet(f"{path}/totals")


def load_stats(spark, path: str) -> FittedStats:
    totals = spark.read.parquet(f"{path}/totals")
    overall = totals.first()
    return FittedStats(
        spark.read.parquet(f"{path}/carriers"),
        spark.read.parquet(f"{path}/routes"),
        totals,
        overall["global_delay_rate"],
        overall["global_avg_delay"],
    )


def add_features(rows: DataFrame, stats: FittedStats) -> DataFrame:
    """All columns of `rows` plus the twelve features (same-named ones replaced).

    The statistic tables come from files, so the joins are broadcast only below
    the session's size threshold.
    """
    rate = FEATURE_DEFAULT_RATE if stats.global_rate is None else stats.global_rate
    delay = FEATURE_DEFAULT_DELAY if stats.global_delay is None else stats.global_delay
    filled = {
        name: F.coalesce(F.col(name).cast("int"), F.lit(value))
        for name, value in FEATURE_FILL.items()
    }
    hour = F.col("scheduled_departure_hour")
    angle = 2 * F.pi() * hour / 24
    joined = (
        rows.withColumns(filled)
        .join(stats.carriers.drop("carrier_flights"), "reporting_airline_code", "left")
        .join(stats.routes.drop("route_flights"), "route_code", "left")
    )
    return joined.withColumns(
        {
            "is_weekend_flag": F.col("is_weekend").cast("int"),
            "departure_hour_sin": F.sin(angle),
            "departure_hour_cos": F.cos(angle),
            "is_peak_hour": (hour.between(7, 9) | hour.between(17, 20)).cast("int"),
            "is_red_eye": (hour <= 5).cast("int"),
            "carrier_historical_delay_rate": F.coalesce(
                "carrier_historical_delay_rate", F.lit(rate)
            ),
            "carrier_avg_delay_minutes": F.coalesce("carrier_avg_delay_minutes", F.lit(delay)),
            "route_congestion_index": F.coalesce("route_congestion_index", F.lit(rate)),
            "route_avg_delay_minutes": F.coalesce("route_avg_delay_minutes", F.lit(delay)),
        }
    )


def feature_columns(rows: DataFrame, stats: FittedStats) -> DataFrame:
    return add_features(rows, stats).select(*FEATURE_COLUMNS)
