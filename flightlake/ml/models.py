"""Boosted delay models, permutation importance and the saved artefacts of a training run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.contracts import CLEAN_KEY, FEATURE_COLUMNS
from flightlake.functions.metrics import rounded
from flightlake.ml import boosting
from flightlake.ml.boosting import BoostSettings, Cells, Ensemble, rounded_features
from flightlake.ml.features import TARGET_FLAG, TARGET_MINUTES, FittedStats, load_stats, save_stats
from flightlake.operators.ranks import running_totals
from flightlake.session import staged
from flightlake.sources.files import complete_version, newest_version, next_version

#: a scorer makes the predicted minutes from the feature columns given by name
Scorer = Callable[[dict[str, Column]], Column]


TARGETS = {"squared": TARGET_MINUTES, "log": TARGET_FLAG}


def _fitted(train: DataFrame | Cells, loss: str, settings: BoostSettings) -> Ensemble:
    if isinstance(train, Cells):
        return boosting.fit_cells(train, loss, settings)
    return boosting.fit(train, FEATURE_COLUMNS, TARGETS[loss], loss, settings)


def fit_regressor(train: DataFrame | Cells, settings: BoostSettings = BoostSettings()) -> Ensemble:
    return _fitted(train, "squared", settings)


def fit_classifier(train: DataFrame | Cells, settings: BoostSettings = BoostSettings()) -> Ensemble:
    return _fitted(train, "log", settings)


def training_cells(train: DataFrame, settings: BoostSettings = BoostSettings()) -> Cells:
    """Cells for both models, binned and dealt once; a row of the population lacks neither target."""
    return boosting.training_cells(train, FEATURE_COLUMNS, TARGETS, settings.bins)


def predict(model: Ensemble, rows: DataFrame, name: str = "model") -> DataFrame:
    """`rows` with the model's minutes (never below zero) or probability as a column expression."""
    return rows.withColumns({f"_seen_{c}": rounded(F.col(c).cast("double"), boosting.DIGITS) for c in FEATURE_COLUMNS}).select(
        *rows.columns, model.output({c: F.col(f"_seen_{c}") for c in FEATURE_COLUMNS}).alias(name)
    )


# ---------------------------------------------------------------- importance


def _ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """`rows` with `_rank`, their dense position from 0 in `order`, by range-partitioned running totals."""
    keyed = rows.withColumns({"_order": F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]), "_row": F.lit(1)})
    return running_totals(keyed, "_order", ["_row"], name).withColumnRenamed("_row_before", "_rank")


def _pick(name: str, *parts: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(name), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def permutation_importance(scorer: Scorer, test: DataFrame, repeats: int = 3, seed: int = 42) -> DataFrame:
    """(feature, importance), normalised, for any scorer of the features, over all test rows.

    Rows are ranked by a digest of their key and, for each repeat, by another digest; a row's donor
    has the rank in that order that the row has in the first one.  Each feature takes the donor's
    value in turn, in one scoring job; importance is the mean loss of R2, never below zero.
    The loss is summed row by row against the row's own plain prediction: a loss far below R2 keeps
    its digits, and a feature that moves no prediction loses exactly nothing.
    """
    predicted = scorer({c: F.col(c) for c in FEATURE_COLUMNS})
    keyed = rounded_features(test, FEATURE_COLUMNS).select(
        *[F.col(c).cast("double").alias(c) for c in FEATURE_COLUMNS],
        F.col(TARGET_MINUTES).alias("_y"),
        _pick(str(seed), *[F.col(c) for c in CLEAN_KEY]).alias("_key"),
    ).withColumn("_plain", predicted)
    # written, so that rows of one key have the same number wherever they are read
    rows = staged(_ranked(keyed, [F.col("_key")], "importance_order").select(*FEATURE_COLUMNS, "_y", "_key", "_plain", "_rank"), "importance_rows")
    many = rows.count()
    copies = rows.select(*FEATURE_COLUMNS, "_key", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("_repeat"))
    mixed = _ranked(copies, [F.col("_repeat"), _pick("donor", F.col("_repeat"), F.col("_key"))], "importance_donors")
    donors = mixed.select(
        "_repeat", (F.col("_rank") - F.col("_repeat") * F.lit(many)).alias("_rank"), *[F.col(c).alias(f"_donor_{c}") for c in FEATURE_COLUMNS]
    )
    features = F.explode(F.array(*[F.lit(c) for c in FEATURE_COLUMNS]))
    trials = donors.join(rows, "_rank").withColumn("feature", features).select(
        "feature", "_y", "_plain",
        *[F.when(F.col("feature") == c, F.col(f"_donor_{c}")).otherwise(F.col(c)).alias(c) for c in FEATURE_COLUMNS],
    )
    scored = trials.select("feature", "_y", "_plain", predicted.alias("_p"))
    # the difference of both squared errors
    more = (F.col("_p") - F.col("_plain")) * ((F.col("_p") - F.col("_y")) + (F.col("_plain") - F.col("_y")))
    losses = staged(scored.groupBy("feature").agg(F.sum(more).alias("loss")), "importance_losses")
    spread = rows.agg(F.nullif(F.var_pop("_y") * F.lit(many * repeats), F.lit(0.0))).scalar()
    drops = losses.select("feature", F.greatest(F.col("loss") / spread, F.lit(0.0)).alias("drop"))
    whole = drops.agg(F.sum("drop")).scalar()
    return drops.select(
        "feature", rounded(F.coalesce(F.col("drop") / F.nullif(whole, F.lit(0.0)), F.lit(0.0)), 5).alias("importance")
    )


def fallback_importance(spark: SparkSession) -> DataFrame:
    """What stands for the importance where none was measured: 0.1 for each feature."""
    return spark.createDataFrame([(c, 0.1) for c in FEATURE_COLUMNS], "feature string, importance double")


def top_drivers(importance: DataFrame | None, spark: SparkSession, n: int = 4) -> DataFrame:
    """The n most important features; without any importance the first n features, 0.1 each."""
    place = F.array_position(F.array(*[F.lit(c) for c in FEATURE_COLUMNS]), F.col("feature"))
    if importance is None or importance.isEmpty():
        return fallback_importance(spark).orderBy(place).limit(n)
    return importance.orderBy(F.desc("importance"), place).limit(n)


# ---------------------------------------------------------------- artefacts


@dataclass(frozen=True)
class TrainingRun:
    """Everything one training run leaves; scoring needs the first two."""

    stats: FittedStats
    classifier: Ensemble | None
    regressor: Ensemble | None
    metrics: DataFrame | None = None
    importance: DataFrame | None = None
    residuals: DataFrame | None = None
    version: int | None = None


_TABLES = ("metrics", "importance", "residuals")


def save_run(run: TrainingRun, path: str) -> int:
    """Write a run under the next version of `path` and return that version.

    The version counts once all its tables are written: its entry in `_versions` comes last.
    Tables that a run lacks are left out.
    """
    spark = run.stats.totals.sparkSession
    version = next_version(spark, path)
    folder = f"{path}/version={version}"
    save_stats(run.stats, f"{folder}/stats", mode="errorifexists")
    for name in ("classifier", "regressor"):
        if (model := getattr(run, name)) is not None:
            model.table(spark).write.parquet(f"{folder}/{name}")
    for name in _TABLES:
        if (table := getattr(run, name)) is not None:
            table.write.parquet(f"{folder}/{name}")
    present = [n for n in ("stats", "classifier", "regressor", *_TABLES) if getattr(run, n) is not None]
    complete_version(spark, path, version, present)
    return version


def load_run(spark: SparkSession, path: str) -> TrainingRun | None:
    """The newest complete run, or None; scoring then falls back to what it has."""
    newest = newest_version(spark, path)
    if newest is None:
        return None
    version, present = newest
    folder = f"{path}/version={version}"
    tables = {n: spark.read.parquet(f"{folder}/{n}") for n in present if n != "stats"}
    models = {n: Ensemble.of_table(tables.pop(n)) if n in tables else None for n in ("classifier", "regressor")}
    return TrainingRun(load_stats(spark, f"{folder}/stats"), **models, **tables, version=version)
