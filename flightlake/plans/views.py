"""Reporting views over the star schema.

Aggregating views group the fact by its surrogate keys first and join the
dimensions to the few result rows.  Natural ids are unique in their dimension
and every fact key resolves (both are audited before a load is published), so
the result is that of joining first, without carrying dimension text through
the aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.contracts import CAUSE_COLUMNS, COST_PER_DELAY_MINUTE_USD, DELAY_CAUSES, FACT_MEASURES
from flightlake.functions.metrics import (
    count_where,
    mean,
    median,
    rounded,
    rounded_total,
    share,
    total,
)
from flightlake.warehouse.load import Star

_AIRPORT = ["airport_id", "airport_code", "city_name", "state_code", "state_name"]
_SIGNED = "arrival_delay_minutes_signed"


def _airports(star: Star, role: str, columns: list[str] = _AIRPORT) -> DataFrame:
    """The airport dimension in one of its two roles."""
    return star.dim_airport.select(
        F.col("airport_key").alias(f"{role}_airport_key"),
        *[F.col(c).alias(f"{role}_{c}") for c in columns],
    )


def _counts() -> dict[str, Column]:
    status, on_time = F.col("flight_status"), F.col("arrival_on_time")
    return {
        "total_flights": F.count(F.lit(1)),
        "completed_flights": count_where(status == "Completed"),
        "cancelled_flights": count_where(status == "Cancelled"),
        "diverted_flights": count_where(status == "Diverted"),
        "eligible_arrivals": count_where(on_time.isNotNull()),
        "on_time_arrivals": count_where(on_time),
        "delayed_arrivals": count_where(~on_time),
    }


def _measures() -> dict[str, Column]:
    counts = _counts()
    return {
        **counts,
        "on_time_arrival_rate_percentage": share(
            counts["on_time_arrivals"], counts["eligible_arrivals"]
        ),
        "cancellation_rate_percentage": share(
            counts["cancelled_flights"], counts["total_flights"]
        ),
        "average_signed_arrival_delay_minutes": rounded(mean(_SIGNED)),
        "average_arrival_delay_minutes": rounded(mean("arrival_delay_minutes")),
        "average_signed_departure_delay_minutes": rounded(mean("departure_delay_minutes_signed")),
        "median_signed_arrival_delay_minutes": rounded(median(F.col(_SIGNED).cast("double"))),
        "average_taxi_out_minutes": rounded(mean("taxi_out_minutes")),
        "average_distance_miles": rounded(mean("distance_miles")),
        "total_reported_delay_minutes": rounded_total(total("total_reported_delay_minutes")),
    }


_RATES = ["on_time_arrival_rate_percentage", "cancellation_rate_percentage"]
_STATUS = ["completed_flights", "cancelled_flights", "diverted_flights"]
_ARRIVALS = ["on_time_arrivals", "delayed_arrivals"]


def _pick(names: list[str], **renamed: str) -> list[Column]:
    """Measures by name; `new="old"` gives one under another name."""
    measures = _measures()
    return [measures[renamed.get(n, n)].alias(n) for n in names]


def flight_detail(star: Star) -> DataFrame:
    """Every fact row with all dimension attributes (63 columns)."""
    joined = (
        star.fact_flight.join(star.dim_date, "date_key")
        .join(star.dim_airline, "airline_key")
        .join(_airports(star, "origin"), "origin_airport_key")
        .join(_airports(star, "destination"), "destination_airport_key")
    )
    airport = [
        [f"{role}_airport_key"] + [f"{role}_{c}" for c in _AIRPORT]
        for role in ("origin", "destination")
    ]
    return joined.withColumnRenamed("full_date", "flight_date").select(
        "flight_key", "date_key", "flight_date", "year_number", "quarter_number", "month_number",
        "month_name", "day_of_month", "day_of_week_number", "day_name", "is_weekend",
        "airline_key", "reporting_airline_id", "reporting_airline_code",
        *airport[0], *airport[1], *FACT_MEASURES,
    )


def overview_metrics(star: Star) -> DataFrame:
    names = [
        "total_flights", *_STATUS, "eligible_arrivals", *_ARRIVALS, *_RATES,
        "average_signed_arrival_delay_minutes", "average_arrival_delay_minutes",
        "median_signed_arrival_delay_minutes", "total_reported_delay_minutes",
    ]
    return star.fact_flight.agg(*_pick(names))


def daily_performance(star: Star) -> DataFrame:
    names = [
        "total_flights", *_STATUS, *_ARRIVALS, *_RATES,
        "average_signed_arrival_delay_minutes", "total_reported_delay_minutes",
    ]
    daily = star.fact_flight.groupBy("date_key").agg(*_pick(names))
    days = star.dim_date.select(
        "date_key", F.col("full_date").alias("flight_date"), "day_name", "is_weekend"
    )
    return daily.join(days, "date_key").select("flight_date", "day_name", "is_weekend", *names)


def airline_performance(star: Star) -> DataFrame:
    names = [
        "total_flights", *_STATUS, "eligible_arrivals", *_ARRIVALS, *_RATES,
        "average_signed_arrival_delay_minutes", "average_signed_departure_delay_minutes",
        "median_signed_arrival_delay_minutes", "average_taxi_out_minutes",
        "total_reported_delay_minutes",
    ]
    grouped = star.fact_flight.groupBy("airline_key").agg(*_pick(names))
    return grouped.join(star.dim_airline, "airline_key").select(
        "reporting_airline_id", "reporting_airline_code", *names
    )


def origin_airport_performance(star: Star) -> DataFrame:
    names = [
        "departing_flights", *_STATUS, *_ARRIVALS, *_RATES,
        "average_signed_departure_delay_minutes", "average_signed_arrival_delay_minutes",
        "average_taxi_out_minutes",
    ]
    grouped = star.fact_flight.groupBy("origin_airport_key").agg(
        *_pick(names, departing_flights="total_flights")
    )
    return grouped.join(_airports(star, "origin"), "origin_airport_key").select(
        *[f"origin_{c}" for c in _AIRPORT], *names
    )


def route_performance(star: Star) -> DataFrame:
    names = [
        "total_flights", *_STATUS, *_ARRIVALS, *_RATES,
        "average_signed_arrival_delay_minutes", "average_distance_miles",
    ]
    keys = ["route_code", "origin_airport_key", "destination_airport_key"]
    shown = _AIRPORT[:4]
    grouped = star.fact_flight.groupBy(*keys).agg(*_pick(names))
    return (
        grouped.join(_airports(star, "origin", shown), "origin_airport_key")
        .join(_airports(star, "destination", shown), "destination_airport_key")
        .select(
            "route_code",
            *[f"origin_{c}" for c in shown],
            *[f"destination_{c}" for c in shown],
            *names,
        )
    )


def departure_hour_performance(star: Star) -> DataFrame:
    names = [
        "total_flights", "cancelled_flights", *_ARRIVALS, *_RATES,
        "average_signed_arrival_delay_minutes",
    ]
    return star.fact_flight.groupBy("scheduled_departure_hour").agg(*_pick(names))


def delay_cause_by_airline(star: Star) -> DataFrame:
    """Long format: one row per airline and cause, with the cause's share."""
    wide = star.fact_flight.groupBy("airline_key").agg(
        count_where(F.col("delay_cause_reported")).alias("flights_with_reported_delay_causes"),
        *[total(c).alias(label) for c, label in DELAY_CAUSES.items()],
    )
    ids = ["reporting_airline_id", "reporting_airline_code", "flights_with_reported_delay_causes"]
    long = wide.join(star.dim_airline, "airline_key").unpivot(
        ids, list(DELAY_CAUSES.values()), "delay_cause", "minutes"
    )
    # five rows per airline
    of_airline = F.sum("minutes").over(Window.partitionBy("reporting_airline_id"))
    return long.select(
        *ids,
        "delay_cause",
        rounded_total(F.col("minutes")).alias("total_delay_minutes"),
        share(F.col("minutes"), of_airline).alias("airline_delay_share_percentage"),
    )


# ---- views whose grouping columns are not unique ids: partial sums, join, final sums ----


def _partial(*extra: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        total("arrival_delay_minutes").alias("delay"),
        F.count("arrival_delay_minutes").alias("n_delay"),
        count_where(F.col("arrival_delayed_15")).alias("n_late"),
        *extra,
    ]


def _ratio_of_sums(top: str, bottom: str) -> Column:
    return rounded(F.sum(top) / F.nullif(F.sum(bottom).cast("double"), F.lit(0.0)))


def _cost() -> Column:
    return rounded_total(F.sum("delay") * COST_PER_DELAY_MINUTE_USD)


def carrier_monthly_performance(star: Star) -> DataFrame:
    partial = star.fact_flight.groupBy("airline_key", "date_key").agg(
        *_partial(
            count_where(F.col("flight_status") == "Completed").alias("n_completed"),
            count_where(F.col("arrival_on_time")).alias("n_on_time"),
        )
    )
    months = star.dim_date.select("date_key", "year_number", "month_number")
    codes = star.dim_airline.select("airline_key", "reporting_airline_code")
    return (
        partial.join(months, "date_key")
        .join(codes, "airline_key")
        .groupBy("reporting_airline_code", "year_number", "month_number")
        .agg(
            F.sum("n").alias("total_flights"),
            F.sum("n_completed").alias("completed_flights"),
            share(F.sum("n_on_time"), F.sum("n")).alias("otp_15_pct"),
            _ratio_of_sums("delay", "n_delay").alias("avg_delay_minutes"),
            _cost().alias("total_delay_cost_usd"),
        )
        .orderBy(F.desc("otp_15_pct"), "reporting_airline_code", "year_number", "month_number")
    )


def airport_congestion_hourly(star: Star) -> DataFrame:
    partial = star.fact_flight.groupBy("origin_airport_key", "scheduled_departure_hour").agg(
        *_partial(
            total("departure_delay_minutes").alias("dep_delay"),
            F.count("departure_delay_minutes").alias("n_dep_delay"),
        )
    )
    places = star.dim_airport.select(
        F.col("airport_key").alias("origin_airport_key"), "airport_code", "city_name"
    )
    return (
        partial.join(places, "origin_airport_key")
        .groupBy("airport_code", "city_name", "scheduled_departure_hour")
        .agg(
            F.sum("n").alias("departures_count"),
            _ratio_of_sums("dep_delay", "n_dep_delay").alias("avg_departure_delay"),
            _ratio_of_sums("delay", "n_delay").alias("avg_arrival_delay"),
            share(F.sum("n_late"), F.sum("n")).alias("delay_risk_pct"),
        )
        .orderBy("airport_code", "scheduled_departure_hour")
    )


def delay_cascade_root_cause(star: Star) -> DataFrame:
    sums = [*CAUSE_COLUMNS, "total_reported_delay_minutes"]
    partial = (
        star.fact_flight.filter("delay_cause_reported")
        .groupBy("airline_key")
        .agg(*[total(c).alias(c) for c in sums])
    )
    codes = star.dim_airline.select("airline_key", "reporting_airline_code")
    return (
        partial.join(codes, "airline_key")
        .groupBy("reporting_airline_code")
        .agg(
            F.sum("carrier_delay_minutes").alias("carrier_delay_min"),
            F.sum("weather_delay_minutes").alias("weather_delay_min"),
            F.sum("national_air_system_delay_minutes").alias("nas_delay_min"),
            F.sum("late_aircraft_delay_minutes").alias("late_aircraft_delay_min"),
            share(
                F.sum("late_aircraft_delay_minutes"), F.sum("total_reported_delay_minutes")
            ).alias("cascade_pct"),
        )
        .orderBy(F.desc("late_aircraft_delay_min"), "reporting_airline_code")
    )


def high_risk_corridors(star: Star, min_flights: int = 200) -> DataFrame:
    keys = ["route_code", "origin_airport_key", "destination_airport_key"]
    partial = star.fact_flight.groupBy(*keys).agg(*_partial())
    return (
        partial.join(_airports(star, "origin", ["airport_code"]), "origin_airport_key")
        .join(_airports(star, "destination", ["airport_code"]), "destination_airport_key")
        .groupBy(
            "route_code",
            F.col("origin_airport_code").alias("origin_code"),
            F.col("destination_airport_code").alias("dest_code"),
        )
        .agg(
            F.sum("n").alias("flight_count"),
            _ratio_of_sums("delay", "n_delay").alias("avg_delay_minutes"),
            share(F.sum("n_late"), F.sum("n")).alias("delay_probability_pct"),
            _cost().alias("total_financial_exposure_usd"),
        )
        .filter(F.col("flight_count") >= min_flights)
        .orderBy(F.desc("avg_delay_minutes"), "route_code")
    )


VIEWS = {
    "vw_flight_detail": flight_detail,
    "vw_overview_metrics": overview_metrics,
    "vw_daily_performance": daily_performance,
    "vw_airline_performance": airline_performance,
    "vw_origin_airport_performance": origin_airport_performance,
    "vw_route_performance": route_performance,
    "vw_departure_hour_performance": departure_hour_performance,
    "vw_delay_cause_by_airline": delay_cause_by_airline,
    "vw_carrier_monthly_performance": carrier_monthly_performance,
    "vw_airport_congestion_hourly": airport_congestion_hourly,
    "vw_delay_cascade_root_cause": delay_cascade_root_cause,
    "vw_high_risk_corridors": high_risk_corridors,
}


def register_views(star: Star) -> list[str]:
    """Make tables and views available to `spark.sql` under their plain names."""
    for name, table in star.tables().items():
        table.createOrReplaceTempView(name)
    for name, build in VIEWS.items():
        build(star).createOrReplaceTempView(name)
    return [*star.tables(), *VIEWS]
