"""Cleaning of the compact (28-column) layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.contracts import AIRPORTS, CARRIERS, COMPACT_COLUMNS, DELAY_THRESHOLD_MINUTES
from flightlake.functions import casts, times
from flightlake.operators.duplicates import distinct_rows
from flightlake.operators.standard import flight_status, missing_columns, on_time

OUTPUT_COLUMNS = """
year quarter month day_of_month day_of_week flight_date reporting_airline_code
reporting_airline_name reporting_airline_id tail_number flight_number origin_airport_id
origin_airport_code origin_city_name origin_state_code origin_state_name
destination_airport_id destination_airport_code destination_city_name
destination_state_code destination_state_name scheduled_departure_time
actual_departure_time departure_delay_minutes_signed departure_delay_minutes
departure_delayed_15 departure_time_block taxi_out_minutes taxi_in_minutes
scheduled_arrival_time actual_arrival_time arrival_delay_minutes_signed
arrival_delay_minutes arrival_delayed_15 arrival_time_block cancelled cancellation_code
diverted scheduled_elapsed_minutes actual_elapsed_minutes air_time_minutes flight_count
distance_miles distance_group carrier_delay_minutes weather_delay_minutes
national_air_system_delay_minutes security_delay_minutes late_aircraft_delay_minutes
delay_cause_reported total_reported_delay_minutes route_code is_weekend
scheduled_departure_hour scheduled_arrival_hour flight_status arrival_on_time
""".split()


_TEXT = ["AIRLINE", "TAIL_NUMBER", "ORIGIN_AIRPORT", "DESTINATION_AIRPORT", "CANCELLATION_REASON"]


def _values(rows: list[tuple], names: list[str]) -> str:
    body = ", ".join(
        "(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in row) + ")" for row in rows
    )
    return f"SELECT * FROM VALUES {body} AS t({', '.join(names)})"


def carrier_table(spark: SparkSession) -> DataFrame:
    """The fixed carrier directory (14 rows) as a local relation."""
    table = spark.sql(_values(CARRIERS, ["carrier_code", "carrier_name", "carrier_id"]))
    return table.withColumn("carrier_id", F.col("carrier_id").cast("int"))


def airport_table(spark: SparkSession) -> DataFrame:
    """The fixed airport directory (51 rows) as a local relation."""
    names = ["airport_code", "city_name", "state_code", "state_name", "airport_id"]
    table = spark.sql(_values(AIRPORTS, names))
    return table.withColumn("airport_id", F.col("airport_id").cast("int"))


def fallback_id(code: Column) -> Column:
    """Stable id 10000-99999 for a code outside the directory; null for no code."""
    digest = F.conv(F.substring(F.md5(code), 1, 8), 16, 10).cast("bigint")
    return (digest % 90000 + 10000).cast("int")


def with_carrier(df: DataFrame, code: str = "reporting_airline_code") -> DataFrame:
    """Add carrier name and id; unknown codes keep the code and get a stable id."""
    table = F.broadcast(carrier_table(df.sparkSession))  # 14 fixed rows
    joined = df.join(table, F.col(code) == F.col("carrier_code"), "left")
    return joined.select(
        *df.columns,
        F.coalesce("carrier_name", code).alias("reporting_airline_name"),
        F.coalesce(F.col("carrier_id"), fallback_id(F.col(code))).alias("reporting_airline_id"),
    )


def with_airport(df: DataFrame, side: str) -> DataFrame:
    """Add id, city and state columns of the `side` airport."""
    code = F.col(f"{side}_airport_code")
    table = F.broadcast(airport_table(df.sparkSession))  # 51 fixed rows
    joined = df.join(table, code == F.col("airport_code"), "left")
    return joined.select(
        *df.columns,
        F.coalesce(F.col("airport_id"), fallback_id(code)).alias(f"{side}_airport_id"),
        F.coalesce("city_name", F.concat(code, F.lit(", US"))).alias(f"{side}_city_name"),
        F.coalesce("state_code", F.lit("US")).alias(f"{side}_state_code"),
        F.coalesce("state_name", F.lit("United States")).alias(f"{side}_state_name"),
    )


def _signed_delay(signed: Column, target: str) -> dict[str, Column]:
    return {
        f"{target}_minutes_signed": signed,
        f"{target}_minutes": F.when(signed.isNotNull(), F.greatest(signed, F.lit(0.0).cast("float"))),
        f"{target}ed_15": (signed >= DELAY_THRESHOLD_MINUTES).cast("int"),
    }


def distance_group(miles: Column) -> Column:
    return F.least(F.floor(miles / 250) + 1, F.lit(11)).cast("int")


def clean_compact(raw: DataFrame, month: int | None = None) -> DataFrame:
    """Clean the compact layout, optionally one month only.

    Rows that repeat in every source column are dropped before the derivation:
    every derived column is a function of the source row, so the set of
    distinct rows is the same and the shuffle carries 28 columns, not 84.
    """
    missing = missing_columns(raw, COMPACT_COLUMNS)
    if missing:
        raise ValueError(f"the raw table lacks these columns: {missing}")
    if month is not None:
        raw = raw.filter(casts.number(raw, "MONTH") == month)
    # parse every number once; everything below only refers to the parsed columns
    rows = distinct_rows(raw).select(
        *[F.col(c) if c in _TEXT else casts.number(raw, c).alias(c) for c in COMPACT_COLUMNS]
    )

    def whole(name: str, kind: str = "int32") -> Column:
        return casts.as_integer(F.col(name), kind)

    def measure(name: str) -> Column:
        return F.col(name).cast("float")

    zero = F.lit(0.0).cast("float")
    scheduled = {
        side: F.coalesce(whole(f"SCHEDULED_{side.upper()}", "int16"), F.lit(0))
        for side in ("departure", "arrival")
    }
    causes = {
        "carrier_delay_minutes": "AIRLINE_DELAY",
        "weather_delay_minutes": "WEATHER_DELAY",
        "national_air_system_delay_minutes": "AIR_SYSTEM_DELAY",
        "security_delay_minutes": "SECURITY_DELAY",
        "late_aircraft_delay_minutes": "LATE_AIRCRAFT_DELAY",
    }
    day = F.make_date(whole("YEAR", "int16"), whole("MONTH", "int8"), whole("DAY", "int8"))
    base = rows.select(
        day.alias("flight_date"),
        casts.trimmed(F.col("AIRLINE")).alias("reporting_airline_code"),
        F.coalesce(whole("FLIGHT_NUMBER", "int64"), F.lit(0)).alias("flight_number"),
        casts.trimmed(F.col("TAIL_NUMBER")).alias("tail_number"),
        casts.trimmed(F.col("ORIGIN_AIRPORT")).alias("origin_airport_code"),
        casts.trimmed(F.col("DESTINATION_AIRPORT")).alias("destination_airport_code"),
        scheduled["departure"].alias("scheduled_departure_time"),
        whole("DEPARTURE_TIME", "int16").alias("actual_departure_time"),
        scheduled["arrival"].alias("scheduled_arrival_time"),
        whole("ARRIVAL_TIME", "int16").alias("actual_arrival_time"),
        *[
            c.alias(name)
            for name, c in {
                **_signed_delay(measure("DEPARTURE_DELAY"), "departure_delay"),
                **_signed_delay(measure("ARRIVAL_DELAY"), "arrival_delay"),
            }.items()
        ],
        F.coalesce(whole("CANCELLED", "int8"), F.lit(0)).alias("cancelled"),
        casts.trimmed(F.col("CANCELLATION_REASON")).alias("cancellation_code"),
        F.coalesce(whole("DIVERTED", "int8"), F.lit(0)).alias("diverted"),
        *[F.coalesce(measure(source), zero).alias(name) for name, source in causes.items()],
        measure("TAXI_OUT").alias("taxi_out_minutes"),
        measure("TAXI_IN").alias("taxi_in_minutes"),
        measure("SCHEDULED_TIME").alias("scheduled_elapsed_minutes"),
        measure("ELAPSED_TIME").alias("actual_elapsed_minutes"),
        measure("AIR_TIME").alias("air_time_minutes"),
        F.coalesce(measure("DISTANCE"), zero).alias("distance_miles"),
        F.lit(1).alias("flight_count"),
    )
    total = sum((F.col(name).cast("double") for name in causes), F.lit(0.0))
    status = flight_status(F.col("cancelled"), F.col("diverted"))
    hours = {
        f"scheduled_{side}_hour": times.hhmm_hour(F.col(f"scheduled_{side}_time"))
        for side in ("departure", "arrival")
    }
    full = (
        base.withColumns(hours)
        .withColumns(
            {
                **times.calendar(F.col("flight_date")),
                "is_weekend": times.is_weekend(F.col("flight_date")),
                "departure_time_block": times.hour_block(F.col("scheduled_departure_hour")),
                "arrival_time_block": times.hour_block(F.col("scheduled_arrival_hour")),
                "flight_status": status,
                "arrival_on_time": on_time(status, F.col("arrival_delayed_15")),
                "total_reported_delay_minutes": total.cast("float"),
                "delay_cause_reported": total > 0,
                "distance_group": distance_group(F.col("distance_miles")),
                "route_code": F.concat(
                    F.col("origin_airport_code"), F.lit("-"), F.col("destination_airport_code")
                ),
            }
        )
        .transform(with_carrier)
        .transform(with_airport, "origin")
        .transform(with_airport, "destination")
    )
    return full.select(*OUTPUT_COLUMNS)
