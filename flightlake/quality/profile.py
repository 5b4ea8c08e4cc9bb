"""Profile of a raw table: schema, nulls, types, coverage, duplicates, volumes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.contracts import RAW_COLUMNS, RAW_KEY
from flightlake.functions import casts
from flightlake.functions.metrics import count_where, ratio, rounded
from flightlake.operators.duplicates import duplicate_counts


def _per_column(df: DataFrame, build) -> DataFrame:
    """One pass over the table, then one row per column: `build(name)` gives the fields."""
    fields = {name: build(name) for name in df.columns}
    counted = df.agg(
        *[expr.alias(f"{key}|{name}") for name, kv in fields.items() for key, expr in kv.items()]
    )
    structs = [
        F.struct(
            F.lit(name).alias("column_name"),
            *[F.col(f"`{key}|{name}`").alias(key) for key in kv],
        )
        for name, kv in fields.items()
    ]
    return counted.select(F.inline(F.array(*structs)))


def schema_diff(raw: DataFrame, expected: list[str] = RAW_COLUMNS) -> DataFrame:
    """(column_name, finding, affected_rows) for missing and unexpected columns."""
    missing = sorted(set(expected) - set(raw.columns))
    unexpected = sorted(set(raw.columns) - set(expected))
    findings = [
        F.struct(F.lit(name).alias("column_name"), F.lit(kind).alias("finding"))
        for kind, names in (("missing", missing), ("unexpected", unexpected))
        for name in names
    ]
    if not findings:
        empty = raw.sparkSession.range(0)
        return empty.select(
            F.lit("").alias("column_name"), F.lit("").alias("finding"), F.col("id").alias("affected_rows")
        )
    rows = raw.agg(F.count(F.lit(1)).alias("affected_rows"))
    return rows.select(F.inline(F.array(*findings)), "affected_rows")


def missing_values(raw: DataFrame) -> DataFrame:
    """(column_name, missing_count, missing_percentage), most incomplete first."""
    counted = _per_column(
        raw,
        lambda name: {
            "missing_count": count_where(F.col(name).isNull()),
            "total": F.count(F.lit(1)),
        },
    )
    share = F.coalesce(rounded(100.0 * ratio(F.col("missing_count"), F.col("total"))), F.lit(0.0))
    return counted.select("column_name", "missing_count", share.alias("missing_percentage")).orderBy(
        F.desc("missing_percentage"), "column_name"
    )


def column_types(raw: DataFrame) -> DataFrame:
    """(column_name, data_type): int64, float64 or object, decided by the values.

    A column of whole numbers without gaps is int64, other numbers (or a column
    without any value) float64, everything else object.
    """
    numbers = raw.select(
        *[casts.number(raw, c).alias(f"n_{c}") for c in raw.columns], *raw.columns
    )
    counts = []
    for c in raw.columns:
        n = F.col(f"n_{c}")
        counts += [
            F.count(F.lit(1)).alias(f"rows|{c}"),
            F.count(c).alias(f"present|{c}"),
            F.count(n).alias(f"numeric|{c}"),
            count_where((n == F.floor(n)) & ~F.col(c).cast("string").contains(".")).alias(f"whole|{c}"),
        ]
    structs = []
    for c in raw.columns:
        rows, present, numeric, whole = (
            F.col(f"`{key}|{c}`") for key in ("rows", "present", "numeric", "whole")
        )
        kind = (
            F.when((numeric < present), "object")
            .when((whole == rows) & (rows > 0), "int64")
            .otherwise("float64")
        )
        structs.append(F.struct(F.lit(c).alias("column_name"), kind.alias("data_type")))
    return numbers.agg(*counts).select(F.inline(F.array(*structs)))


def date_coverage(raw: DataFrame) -> DataFrame:
    day = casts.flight_date(raw, "FL_DATE")
    return raw.select(day.alias("day")).agg(
        F.min("day").alias("first_date"),
        F.max("day").alias("last_date"),
        count_where(F.col("day").isNull()).alias("invalid_dates"),
    )


def duplicates(raw: DataFrame) -> DataFrame:
    return duplicate_counts(raw.select(*RAW_COLUMNS), RAW_KEY).select(
        "exact_duplicates", "duplicate_key_rows"
    )


def flight_volumes(raw: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct carriers and airports, cancelled, diverted and late counts."""
    distinct = F.approx_count_distinct if approximate else F.countDistinct
    flags = raw.select(
        "OP_CARRIER_AIRLINE_ID",
        "ORIGIN_AIRPORT_ID",
        "DEST_AIRPORT_ID",
        *[casts.number(raw, c).alias(c) for c in ("CANCELLED", "DIVERTED", "ARR_DEL15")],
    )
    # distinct per id after a grouped pre-count: plain counters ride along as sums
    ids = ["OP_CARRIER_AIRLINE_ID", "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID"]
    grouped = flags.groupBy(*ids).agg(
        count_where(F.col("CANCELLED") == 1).alias("cancelled"),
        count_where(F.col("DIVERTED") == 1).alias("diverted"),
        count_where(F.col("ARR_DEL15") == 1).alias("late"),
    )
    return grouped.agg(
        distinct("OP_CARRIER_AIRLINE_ID").alias("unique_airlines"),
        distinct("ORIGIN_AIRPORT_ID").alias("unique_origins"),
        distinct("DEST_AIRPORT_ID").alias("unique_destinations"),
        F.sum("cancelled").alias("cancelled_flights"),
        F.sum("diverted").alias("diverted_flights"),
        F.sum("late").alias("late_flights"),
    )


# ---------------------------------------------------------------- mergeable profiles

SKETCHED = ["reporting_airline_id", "origin_airport_id", "destination_airport_id", "route_code", "flight_number"]
#: log2 of the registers of a sketch, and its relative standard error
SKETCH_BITS, SKETCH_ERROR = 12, 1.04 / 2**6


def write_month_profiles(clean: DataFrame, path: str) -> None:
    """One row a month beside the clean table: rows and a distinct-count sketch (4 KB at most) per column."""
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(SKETCH_BITS)).alias(c) for c in SKETCHED]
    months = clean.groupBy("year", "month").agg(F.count(F.lit(1)).alias("flights"), *sketches)
    months.write.mode("errorifexists").parquet(path)


def period_profile(months: DataFrame, first: tuple[int, int], last: tuple[int, int]) -> DataFrame:
    """(metric, estimate) of a period from its months' sketches alone; the flights are not read again.

    Sketches of months are united, so an id that flies in several months counts once.  A period
    without months has estimate 0.
    """
    at = F.struct("year", "month")
    inside = months.filter((at >= F.struct(F.lit(first[0]), F.lit(first[1]))) & (at <= F.struct(F.lit(last[0]), F.lit(last[1]))))
    united = inside.agg(
        F.coalesce(F.sum("flights"), F.lit(0)).alias("flights"),
        *[F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).alias(c) for c in SKETCHED],
    )
    return united.unpivot([], ["flights", *SKETCHED], "metric", "estimate")
