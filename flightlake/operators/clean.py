"""Entry point for cleaning, publishing a clean table, and its summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.functions.metrics import count_where, ratio, rounded
from flightlake.operators.compact import clean_compact
from flightlake.operators.standard import clean_by_digest
from flightlake.sources.files import CLEAN_ORDER, ROW_ID, layout_of, write_clean_table, write_ranged


def clean_flights(raw: DataFrame, enforce: bool = True, month: int | None = None) -> DataFrame:
    """Clean either source layout; the column names tell which one it is.

    `month` keeps that month of a compact file, which holds a whole year; a standard file is one month.
    """
    if layout_of(raw) == "compact":
        return clean_compact(raw, month)
    return clean_by_digest(raw, enforce)


def publish_clean(raw: DataFrame, path: str, mode: str = "errorifexists", month: int | None = None) -> DataFrame:
    """Clean `raw`, write the month-partitioned table, return it as read back."""
    if layout_of(raw) == "compact":
        write_clean_table(clean_flights(raw, month=month), path, mode)
    else:  # the ranges of the source rows are those of the clean ones
        write_ranged(clean_by_digest(raw, order=CLEAN_ORDER), path, mode)
    return raw.sparkSession.read.parquet(path).drop(ROW_ID)


def clean_summary(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """(metric, value) rows: volumes, duplicates, status mix, on-time share."""
    completed = count_where(F.col("flight_status") == "Completed")
    cancelled = count_where(F.col("flight_status") == "Cancelled")
    diverted = count_where(F.col("flight_status") == "Diverted")
    on_time = count_where(F.col("arrival_on_time"))
    delayed = count_where(~F.col("arrival_on_time"))
    rows = F.count(F.lit(1))
    on_time_share = 100.0 * F.coalesce(ratio(on_time, completed), F.lit(0.0))
    metrics = {
        "clean_rows": rows,
        "completed": completed,
        "completed_pct": rounded(100.0 * ratio(completed, rows), 1),
        "cancelled": cancelled,
        "cancelled_pct": rounded(100.0 * ratio(cancelled, rows), 1),
        "diverted": diverted,
        "diverted_pct": rounded(100.0 * ratio(diverted, rows), 1),
        "on_time": on_time,
        "on_time_pct": rounded(on_time_share),
        "delayed": delayed,
        "delayed_pct": rounded(100.0 - on_time_share),
    }
    after = clean.agg(*[c.cast("double").alias(name) for name, c in metrics.items()])
    before = raw.agg(F.count(F.lit(1)).cast("double"))
    both = after.withColumns(
        {
            "input_rows": before.scalar(),
            "input_columns": F.lit(float(len(raw.columns))),
            "clean_columns": F.lit(float(len(clean.columns))),
        }
    ).withColumn("duplicates_removed", F.col("input_rows") - F.col("clean_rows"))
    names = ["input_rows", "input_columns", "clean_columns", "duplicates_removed", *metrics]
    return both.unpivot([], names, "metric", "value")
