"""Parameterised dashboard queries over the clean table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.contracts import COST_PER_DELAY_MINUTE_USD, DELAY_CAUSES
from flightlake.functions.metrics import count_where, mean, rounded, rounded_total, share, total

# Cause labels of the breakdown chart.
CAUSE_LABELS = {
    "late_aircraft_delay_minutes": "Late Aircraft Cascade",
    "carrier_delay_minutes": "Air Carrier Control",
    "national_air_system_delay_minutes": "National Airspace (NAS)",
    "weather_delay_minutes": "Severe Weather",
    "security_delay_minutes": "Security Incident",
}


def filtered(
    flights: DataFrame,
    carriers: Sequence[str] = (),
    origins: Sequence[str] = (),
    first: dt.date | None = None,
    last: dt.date | None = None,
) -> DataFrame:
    """Carrier, origin and date filters; an empty one selects everything."""
    if carriers:
        flights = flights.filter(F.col("reporting_airline_code").isin(list(carriers)))
    if origins:
        flights = flights.filter(F.col("origin_airport_code").isin(list(origins)))
    if first and last:
        flights = flights.filter(F.col("flight_date").between(F.lit(first), F.lit(last)))
    return flights


def completed(flights: DataFrame) -> DataFrame:
    return flights.filter(F.col("flight_status") == "Completed")


def _on_time_pct() -> Column:
    """Over arrivals with a known flag."""
    return share(count_where(F.col("arrival_on_time")), F.count("arrival_on_time"))


def _late_pct() -> Column:
    return share(count_where(F.col("arrival_delayed_15") == 1), F.count("arrival_delayed_15"))


def _volume() -> Column:
    return F.count("flight_number")


def _mean_delay() -> Column:
    return rounded(mean("arrival_delay_minutes"))


def carrier_options(flights: DataFrame) -> DataFrame:
    codes = flights.select("reporting_airline_code").filter("reporting_airline_code IS NOT NULL")
    return codes.distinct().orderBy("reporting_airline_code")


def top_origins(flights: DataFrame, n: int = 30) -> DataFrame:
    counts = (
        flights.filter("origin_airport_code IS NOT NULL")
        .groupBy("origin_airport_code")
        .agg(F.count(F.lit(1)).alias("flights"))
    )
    return counts.orderBy(F.desc("flights"), "origin_airport_code").limit(n)


def date_bounds(flights: DataFrame) -> DataFrame:
    return flights.agg(
        F.min("flight_date").alias("first_date"), F.max("flight_date").alias("last_date")
    )


def kpis(flights: DataFrame) -> DataFrame:
    """One row; on-time share over completed flights, cancellations over all."""
    done = F.col("flight_status") == "Completed"
    delay = F.when(done, F.col("arrival_delay_minutes").cast("double"))
    dep_delay = F.when(done, F.col("departure_delay_minutes").cast("double"))
    n_done = count_where(done)
    cancelled = count_where(F.col("flight_status") == "Cancelled")
    on_time = count_where(done & F.col("arrival_on_time"))
    minutes = F.coalesce(F.sum(delay), F.lit(0.0))
    return flights.agg(
        F.count(F.lit(1)).alias("total_flights"),
        n_done.alias("completed_flights"),
        cancelled.alias("cancelled_flights"),
        count_where(F.col("flight_status") == "Diverted").alias("diverted_flights"),
        on_time.alias("on_time_arrivals"),
        F.coalesce(share(on_time, n_done), F.lit(0.0)).alias("otp_pct"),
        count_where(done & (F.col("arrival_delayed_15") == 1)).alias("delayed_flights"),
        F.coalesce(rounded(F.avg(delay)), F.lit(0.0)).alias("avg_arrival_delay"),
        F.coalesce(rounded(F.avg(dep_delay)), F.lit(0.0)).alias("avg_departure_delay"),
        rounded_total(minutes).alias("total_delay_minutes"),
        rounded_total(minutes * COST_PER_DELAY_MINUTE_USD).alias("total_cost_usd"),
        F.coalesce(share(cancelled, F.count(F.lit(1))), F.lit(0.0)).alias("cancellation_rate_pct"),
    )


def hour_cascade(flights: DataFrame) -> DataFrame:
    hours = completed(flights).filter(F.col("scheduled_departure_hour").between(5, 23))
    return hours.groupBy("scheduled_departure_hour").agg(
        _mean_delay().alias("avg_delay"),
        _late_pct().alias("delay_rate"),
        _volume().alias("flight_volume"),
    )


def cause_breakdown(flights: DataFrame) -> DataFrame:
    sums = completed(flights).agg(
        *[F.coalesce(total(c), F.lit(0.0)).alias(CAUSE_LABELS[c]) for c in DELAY_CAUSES],
        F.coalesce(sum((total(c) for c in DELAY_CAUSES), F.lit(0.0)), F.lit(0.0)).alias("whole"),
    )
    long = sums.unpivot(["whole"], list(CAUSE_LABELS.values()), "cause", "minutes")
    return long.select(
        "cause",
        rounded_total(F.col("minutes")).alias("minutes"),
        F.coalesce(share(F.col("minutes"), F.col("whole")), F.lit(0.0)).alias("percentage"),
    ).orderBy("minutes", "cause")


def daily_trend(flights: DataFrame) -> DataFrame:
    return (
        completed(flights)
        .groupBy("flight_date")
        .agg(
            _volume().alias("total_flights"),
            _on_time_pct().alias("otp"),
            _mean_delay().alias("avg_delay"),
        )
    )


def carrier_ranking(flights: DataFrame) -> DataFrame:
    return (
        completed(flights)
        .groupBy("reporting_airline_code")
        .agg(
            _volume().alias("total_flights"),
            _on_time_pct().alias("otp"),
            _mean_delay().alias("avg_delay"),
        )
        .orderBy("otp", "reporting_airline_code")
    )


def congested_hubs(flights: DataFrame, min_flights: int = 2000, n: int = 15) -> DataFrame:
    return (
        completed(flights)
        .groupBy("origin_airport_code")
        .agg(
            _volume().alias("flight_volume"),
            _late_pct().alias("delay_rate"),
            _mean_delay().alias("avg_delay"),
        )
        .filter(F.col("flight_volume") >= min_flights)
        .orderBy(F.desc("delay_rate"), "origin_airport_code")
        .limit(n)
    )


def delayed_corridors(flights: DataFrame, min_flights: int = 200, n: int = 20) -> DataFrame:
    cost = total("arrival_delay_minutes") * COST_PER_DELAY_MINUTE_USD
    return (
        completed(flights)
        .groupBy("route_code")
        .agg(
            _volume().alias("volume"),
            _mean_delay().alias("avg_delay"),
            _late_pct().alias("delay_rate"),
            rounded_total(cost).alias("total_delay_cost"),
        )
        .filter(F.col("volume") >= min_flights)
        .orderBy(F.desc("avg_delay"), "route_code")
        .limit(n)
    )


def carrier_preview(flights: DataFrame) -> DataFrame:
    cost = total("arrival_delay_minutes") * COST_PER_DELAY_MINUTE_USD / 1e6
    return (
        completed(flights)
        .groupBy("reporting_airline_code")
        .agg(
            _volume().alias("total_flights"),
            _on_time_pct().alias("otp_15_pct"),
            _mean_delay().alias("avg_delay_min"),
            rounded_total(cost).alias("cost_exposure_musd"),
        )
        .orderBy(F.desc("otp_15_pct"), "reporting_airline_code")
    )


# ---- operational findings from the data ----


def hub_buffers(flights: DataFrame, from_hour: int = 16) -> DataFrame:
    """Late-aircraft share of reported delay in the late bank, per origin."""
    late = F.coalesce(total("late_aircraft_delay_minutes"), F.lit(0.0))
    every = F.coalesce(total("total_reported_delay_minutes"), F.lit(0.0))
    return (
        completed(flights)
        .filter(F.col("scheduled_departure_hour") >= from_hour)
        .groupBy("origin_airport_code")
        .agg(
            F.count(F.lit(1)).alias("flights"),
            rounded_total(late).alias("late_aircraft_minutes"),
            rounded_total(every).alias("reported_minutes"),
            share(late, every).alias("late_aircraft_share_pct"),
        )
    )


def padded_routes(route_stats: DataFrame, top_share: float = 0.10) -> DataFrame:
    """Routes at or above the congestion quantile; input is one row per route."""
    threshold = route_stats.agg(F.percentile("route_congestion_index", 1.0 - top_share)).scalar()
    return route_stats.filter(F.col("route_congestion_index") >= threshold).select(
        "route_code",
        rounded(F.col("route_congestion_index"), 6).alias("route_congestion_index"),
        rounded(F.col("route_avg_delay_minutes")).alias("route_avg_delay_minutes"),
    )


def reserve_carriers(flights: DataFrame, above_pct: float = 25.0) -> DataFrame:
    return (
        completed(flights)
        .groupBy("reporting_airline_code")
        .agg(
            _volume().alias("total_flights"),
            _late_pct().alias("delay_rate_pct"),
            rounded_total(total("carrier_delay_minutes") * COST_PER_DELAY_MINUTE_USD).alias(
                "carrier_delay_cost_usd"
            ),
        )
        .filter(F.col("delay_rate_pct") > above_pct)
    )
