"""Global-median and route-by-carrier-median baselines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.operators.ranks import grouped_medians, weighted_quantiles
from flightlake.ml.features import TARGET_FLAG, TARGET_MINUTES
from flightlake.session import staged


@dataclass(frozen=True)
class Baselines:
    pairs: DataFrame  # route_code, reporting_airline_code, pair_median
    carriers: DataFrame  # reporting_airline_code, carrier_median
    summary: DataFrame  # one row: global_median, global_delay_rate
    global_median: float
    global_rate: float


def fit_baselines(train: DataFrame) -> Baselines:
    """Exact medians at three levels from one histogram.

    Rows collapse to (route, carrier, minutes) -> count before anything is
    grouped, so a route or carrier with a third of all rows costs as much as
    any other.  Medians are picked by rank, so no group's minutes are held in memory.
    """
    histogram = staged(
        train.groupBy("route_code", "reporting_airline_code", TARGET_MINUTES).agg(
            F.count(F.lit(1)).alias("rows"), F.sum(TARGET_FLAG).alias("late")
        ),
        "delay_histogram",
    )
    keys = ["route_code", "reporting_airline_code"]
    pairs = staged(grouped_medians(histogram, keys, TARGET_MINUTES, "rows", "pair_median", "pair_minutes"), "pair_medians")
    carriers = staged(
        grouped_medians(histogram, keys[1:], TARGET_MINUTES, "rows", "carrier_median", "carrier_minutes"), "carrier_medians"
    )
    overall = weighted_quantiles(histogram, TARGET_MINUTES, "rows", {"global_median": 0.5}, "all_minutes")
    summary = histogram.agg(
        overall.scalar().alias("global_median"),
        (F.sum("late") / F.sum("rows").cast("double")).alias("global_delay_rate"),
    )
    row = summary.first()
    return Baselines(pairs, carriers, summary, row["global_median"], row["global_delay_rate"])


def predict_heuristic(rows: DataFrame, fitted: Baselines, name: str = "heuristic") -> DataFrame:
    """Pair median, else carrier median, else global median."""
    return (
        rows.join(fitted.pairs, ["route_code", "reporting_airline_code"], "left")
        .join(fitted.carriers, "reporting_airline_code", "left")
        .withColumn(name, F.coalesce("pair_median", "carrier_median", F.lit(fitted.global_median)))
        .drop("pair_median", "carrier_median")
    )
