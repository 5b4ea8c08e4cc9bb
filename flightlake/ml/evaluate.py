"""Evaluation of regression and classification tiers, residuals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.functions.metrics import count_where, ratio, rounded
from flightlake.operators.ranks import exact_quantiles, running_totals


def regression_metrics(
    rows: DataFrame, truth: str, predicted: str, label: str, whole_minutes: bool = False
) -> DataFrame:
    """One row: MAE, RMSE, median absolute error, MAPE without zeros, R2.

    `whole_minutes` states that errors take few distinct values, so the median
    fits in an aggregate buffer; otherwise it is ranked in a distributed way.
    """
    y, error = F.col("y"), F.col("y") - F.col("p")
    pairs = rows.select(
        F.col(truth).cast("double").alias("y"), F.col(predicted).cast("double").alias("p")
    )
    ss_res, ss_tot = F.sum(error * error), F.var_pop(y) * F.count(y)
    r2 = F.when(ss_tot > 0, 1.0 - ss_res / ss_tot)
    if whole_minutes:
        middle = F.percentile(F.abs(error), 0.5)
    else:
        errors = pairs.select(F.abs(error).alias("e"))
        middle = exact_quantiles(errors, "e", {"q": 0.5}, "errors").scalar()
    measured = pairs.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        *([middle.alias("mdae")] if whole_minutes else []),
        (100.0 * F.avg(F.when(y != 0, F.abs(error / F.nullif(y, F.lit(0.0)))))).alias("mape"),
        r2.alias("r2"),
    )
    return measured.select(
        F.lit(label).alias("model"),
        rounded(F.col("mae"), 3).alias("mae_minutes"),
        rounded(F.col("rmse"), 3).alias("rmse_minutes"),
        rounded(F.col("mdae") if whole_minutes else middle, 3).alias("median_ae_minutes"),
        rounded(F.col("mape")).alias("mape_pct"),
        rounded(F.col("r2"), 4).alias("r2"),
    )


def auc(rows: DataFrame, truth: str, score: str) -> DataFrame:
    """One row with the exact area under the ROC curve (ties count half).

    Rows collapse to one per distinct score; the running count of negatives is
    taken over those, range-partitioned.
    """
    by_score = rows.groupBy(F.col(score).alias("score")).agg(
        count_where(F.col(truth) == 1).alias("pos"), count_where(F.col(truth) == 0).alias("neg")
    )
    ranked = running_totals(by_score, "score", ["neg"], "scores")
    wins = F.sum(F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2.0))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg((wins / F.nullif(pairs, F.lit(0.0))).alias("auc"))


def classification_metrics(rows: DataFrame, truth: str, score: str, label: str) -> DataFrame:
    """One row: AUC and the usual rates at threshold 0.5 (0 when undefined)."""
    actual, guess = F.col(truth) == 1, F.col(score) >= 0.5

    def safe(part: Column, whole: Column) -> Column:
        return F.coalesce(ratio(part, whole), F.lit(0.0))

    counts = rows.agg(
        F.count(F.lit(1)).alias("n"),
        count_where(actual & guess).alias("tp"),
        count_where(~actual & guess).alias("fp"),
        count_where(actual & ~guess).alias("fn"),
        count_where(~actual & ~guess).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        F.lit(label).alias("model"),
        rounded(auc(rows, truth, score).scalar(), 4).alias("roc_auc"),
        rounded(safe(tp + tn, F.col("n")), 4).alias("accuracy"),
        rounded(safe(tp, tp + fp), 4).alias("precision"),
        rounded(safe(tp, tp + fn), 4).alias("recall"),
        rounded(safe(2 * tp, 2 * tp + fp + fn), 4).alias("f1"),
    )


def residual_analysis(rows: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(metric, value): mean, spread, sign shares and tail of the residuals."""
    residuals = rows.select((F.col(truth).cast("double") - F.col(predicted)).alias("r"))
    errors = residuals.select(F.abs("r").alias("e"))
    tail = exact_quantiles(errors, "e", {"p95": 0.95, "p99": 0.99}, "residuals")
    r = F.col("r")
    main = residuals.agg(
        rounded(F.avg(r), 3).alias("mean_residual"),
        rounded(F.stddev_pop(r), 3).alias("std_residual"),
        rounded(100.0 * ratio(count_where(r < 0), F.count(r))).alias("pct_residual_negative"),
        rounded(100.0 * ratio(count_where(r > 0), F.count(r))).alias("pct_residual_positive"),
    )
    tail = tail.select(
        rounded(F.col("p95"), 1).alias("p95_absolute_error"),
        rounded(F.col("p99"), 1).alias("p99_absolute_error"),
    )
    return main.unpivot([], main.columns, "metric", "value").unionByName(
        tail.unpivot([], tail.columns, "metric", "value")
    )
