"""Features, baselines, metrics, boosted trees, scoring."""

from __future__ import annotations

import datetime as dt
import inspect
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flightlake.catalog import QUERIES, Workspace
from flightlake.contracts import FEATURE_COLUMNS
from flightlake.ml import baselines, boosting, evaluate, features, models, score
from flightlake.operators.ranks import exact_quantiles, grouped_medians, running_totals
from flightlake.sources import files

SCHEMA = """flight_date date, reporting_airline_id int, reporting_airline_code string,
flight_number bigint, origin_airport_id int, destination_airport_id int,
scheduled_departure_time int, route_code string, scheduled_departure_hour int, day_of_month int,
day_of_week int, is_weekend boolean, distance_group int, arrival_delay_minutes double,
arrival_delayed_15 int, flight_status string"""


def flights(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        carrier, route, hour = rng.choice("ABC"), rng.choice(["X-Y", "Y-X", "X-Z"]), rng.randrange(24)
        late = max(0, int(rng.gauss(hour + 10 * (carrier == "C"), 8)))
        day = dt.date(2024, 1, 1 + i % 31)
        rows.append(
            (day, ord(carrier), carrier, i, 1, 2, hour * 100, route, hour, day.day, day.isoweekday(),
             day.isoweekday() > 5, 1 + i % 11, float(late), int(late >= 15), "Completed")
        )
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def parts(spark):
    rows = features.population(flights(spark)).cache()
    train, test = features.train_rows(rows), features.test_rows(rows)
    return train, test, features.fit_stats(train)


def test_split_is_chronological(parts):
    train, test, _ = parts
    assert train.agg(F.max("day_of_month")).first()[0] == 23
    assert test.agg(F.min("day_of_month")).first()[0] == 24


def test_features_are_complete(parts):
    train, test, stats = parts
    made = features.feature_columns(test, stats)
    assert made.columns == FEATURE_COLUMNS
    assert made.count() == test.count()
    assert made.dropna().count() == test.count()


def test_stats_against_plain_arithmetic(parts):
    train, _, stats = parts
    pdf = train.toPandas()
    rate = pdf["arrival_delayed_15"].mean()
    assert stats.global_rate == pytest.approx(rate)
    for row in stats.routes.collect():
        mine = pdf[pdf["route_code"] == row["route_code"]]
        smooth = (mine["arrival_delayed_15"].sum() + 30 * rate) / (len(mine) + 30)
        assert row["route_congestion_index"] == pytest.approx(smooth)
        assert row["route_avg_delay_minutes"] == pytest.approx(mine["arrival_delay_minutes"].mean())


def test_test_rows_do_not_leak_into_stats(spark, parts):
    train, test, stats = parts
    rows = features.population(flights(spark))
    moved = rows.withColumn(
        "arrival_delay_minutes",
        F.when(F.col("day_of_month") >= 24, 999.0).otherwise(F.col("arrival_delay_minutes")),
    )
    again = features.fit_stats(features.train_rows(moved))
    assert again.global_delay == stats.global_delay
    assert sorted(again.routes.collect()) == sorted(stats.routes.collect())


def test_unseen_carrier_and_missing_values_fall_back(spark, parts):
    _, test, stats = parts
    odd = test.limit(1).withColumns(
        {
            "reporting_airline_code": F.lit("??"),
            "route_code": F.lit("?-?"),
            "distance_group": F.lit(None).cast("int"),
            "scheduled_departure_hour": F.lit(None).cast("int"),
        }
    )
    row = features.feature_columns(odd, stats).first()
    assert row["carrier_historical_delay_rate"] == stats.global_rate
    assert row["route_avg_delay_minutes"] == stats.global_delay
    assert (row["distance_group"], row["scheduled_departure_hour"]) == (5, 12)


def test_stats_survive_saving(spark, parts, tmp_path):
    _, _, stats = parts
    features.save_stats(stats, str(tmp_path))
    loaded = features.load_stats(spark, str(tmp_path))
    assert loaded.global_rate == stats.global_rate
    assert sorted(loaded.carriers.collect()) == sorted(stats.carriers.collect())


def test_heuristic_medians(parts):
    train, test, _ = parts
    fitted = baselines.fit_baselines(train)
    pdf = train.toPandas()
    assert fitted.global_median == pdf["arrival_delay_minutes"].median()
    expected = pdf.groupby(["route_code", "reporting_airline_code"])["arrival_delay_minutes"].median()
    for row in baselines.predict_heuristic(test, fitted).collect():
        assert row["heuristic"] == expected[(row["route_code"], row["reporting_airline_code"])]
    unseen = test.limit(1).withColumn("route_code", F.lit("?"))
    carrier = unseen.first()["reporting_airline_code"]
    by_carrier = pdf.groupby("reporting_airline_code")["arrival_delay_minutes"].median()
    assert baselines.predict_heuristic(unseen, fitted).first()["heuristic"] == by_carrier[carrier]


def test_running_totals_and_quantiles_are_exact(spark):
    rng = random.Random(5)
    values = [rng.gauss(0, 5) for _ in range(300)] + [1.5] * 150  # a third in one value
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = exact_quantiles(df, "v", {"a": 0.5, "b": 0.95, "c": 0.0, "d": 1.0}, "q").first()
    assert list(found) == pytest.approx([np.percentile(values, p) for p in (50, 95, 0, 100)])
    counts = df.groupBy("v").agg(F.count("*").alias("n"))
    total = 0
    for row in running_totals(counts, "v", ["n"], "t").orderBy("v").collect():
        assert row["n_before"] == total
        total += row["n"]


def test_grouped_medians_of_fractions(spark):
    """A hot group over many partitions, even and odd sizes, ties, null keys and values, no rows."""
    rng = random.Random(8)
    groups = {("hot", 1): 400, ("even", 2): 6, ("odd", None): 7, (None, 3): 1, ("tie", 4): 10}
    rows = [(a, b, round(rng.choice([rng.gauss(0, 9), 2.25]), 3), rng.randint(1, 4)) for (a, b), n in groups.items() for _ in range(n)]
    df = spark.createDataFrame(rows + [("none", 5, None, 2), ("tie", 4, None, 9)], "a string, b int, v double, w long")
    found = {(r.a, r.b): r.m for r in grouped_medians(df, ["a", "b"], "v", "w", "m", "t").collect()}
    expected = {}
    for a, b, v, w in rows:
        expected.setdefault((a, b), []).extend([v] * w)
    assert found.keys() == expected.keys()
    assert all(found[k] == pytest.approx(np.median(v)) for k, v in expected.items())
    assert grouped_medians(df.limit(0), ["a"], "v", "w", "m", "t").count() == 0


def test_auc_counts_ties_half(spark):
    rng = random.Random(9)
    pairs = [(rng.randint(0, 1), rng.randint(0, 9) / 10) for _ in range(200)]
    df = spark.createDataFrame(pairs, "y int, s double")
    wins = [
        (a > b) + 0.5 * (a == b) for y, a in pairs if y == 1 for z, b in pairs if z == 0
    ]
    assert evaluate.auc(df, "y", "s").first()[0] == pytest.approx(np.mean(wins))


def test_metrics_against_numpy(spark):
    rng = np.random.default_rng(3)
    y, p = rng.integers(0, 30, 101).astype(float), rng.normal(12, 5, 101)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    row = evaluate.regression_metrics(df, "y", "p", "m").first()
    keep = y != 0
    assert row["mae_minutes"] == pytest.approx(np.abs(y - p).mean(), abs=1e-3)
    assert row["median_ae_minutes"] == pytest.approx(np.median(np.abs(y - p)), abs=1e-3)
    assert row["mape_pct"] == pytest.approx(100 * np.abs((y - p)[keep] / y[keep]).mean(), abs=1e-2)
    assert row["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum(), abs=1e-4)
    tail = {r["metric"]: r["value"] for r in evaluate.residual_analysis(df, "y", "p").collect()}
    assert tail["std_residual"] == pytest.approx((y - p).std(), abs=1e-3)
    assert tail["p99_absolute_error"] == pytest.approx(np.percentile(np.abs(y - p), 99), abs=0.051)
    flags = df.select((F.col("y") >= 15).cast("int").alias("t"), (F.col("p") / 100).alias("s"))
    weak = evaluate.classification_metrics(flags, "t", "s", "m").first()
    assert (weak["precision"], weak["recall"], weak["f1"]) == (0.0, 0.0, 0.0)


def test_boosted_models_and_importance(spark, parts, tmp_path):
    train, test, stats = parts
    quick = models.BoostSettings(iterations=3, depth=3, min_leaf=5)
    with_features, test_features = features.add_features(train, stats), features.add_features(test, stats)
    regressor = models.fit_regressor(with_features, quick)
    predicted = models.predict(regressor, test_features)
    assert predicted.columns == [*test_features.columns, "model"]
    assert predicted.agg(F.min("model")).first()[0] >= 0
    importance = models.permutation_importance(regressor.output, test_features, 2)
    values = {r["feature"]: r["importance"] for r in importance.collect()}
    assert set(values) == set(FEATURE_COLUMNS)
    assert sum(values.values()) == pytest.approx(1.0, abs=1e-3)
    assert models.top_drivers(importance, spark).count() == 4
    classifier = models.fit_classifier(with_features, quick)
    plain = {r["flight_number"]: r["delay_probability"] for r in score.score(test, stats).collect()}
    mixed = score.score(test, stats, classifier).select(
        "flight_number", "delay_probability", "_model_probability"
    )
    for row in mixed.collect():
        expected = 0.7 * plain[row["flight_number"]] + 0.3 * row["_model_probability"]
        if 0.04 < plain[row["flight_number"]] < 0.90:
            assert row["delay_probability"] == pytest.approx(min(max(expected, 0.04), 0.90))


def grown(x, y, settings):
    """Boosted trees for minutes by plain recursion: predictions of the training rows and leaf sizes."""
    margin, trees = np.full(len(y), y.mean()), []
    for _ in range(settings.iterations):
        g = margin - y

        def split(rows):
            best = (0.0, None, None)
            for f in range(x.shape[1]):
                values = np.unique(x[:, f])
                for low, high in zip(values, values[1:]):
                    left = x[rows, f] <= (low + high) / 2
                    if min(left.sum(), (~left).sum()) < settings.min_leaf:
                        continue
                    a, b = g[rows][left], g[rows][~left]
                    gain = a.sum() ** 2 / len(a) + b.sum() ** 2 / len(b) - g[rows].sum() ** 2 / len(rows)
                    if gain > best[0] + 1e-6:
                        best = (gain, f, (low + high) / 2)
            return best

        leaves = [(np.arange(len(y)), 0)]
        while len(leaves) < settings.leaves:
            found = [split(rows) if depth < settings.depth else (0.0, None, None) for rows, depth in leaves]
            at = max(range(len(leaves)), key=lambda i: found[i][0])
            if found[at][1] is None:
                break
            (rows, depth), (_, f, cut) = leaves.pop(at), found[at]
            left = x[rows, f] <= cut
            leaves += [(rows[left], depth + 1), (rows[~left], depth + 1)]
        for rows, _ in leaves:
            margin[rows] -= settings.rate * g[rows].mean()
        trees.append(sorted(len(rows) for rows, _ in leaves))
    return margin, trees


@pytest.mark.parametrize("leaves,depth", [(6, 4), (31, 2)])
def test_boosting_matches_plain_recursion(spark, leaves, depth):
    rng = np.random.default_rng(8)
    x = np.stack([rng.integers(0, 9, 500), rng.integers(0, 2, 500), np.round(rng.normal(0, 3, 500), 1)], 1).astype(float)
    y = np.round(3 * x[:, 0] + 9 * x[:, 1] * (x[:, 2] > 0) + rng.normal(0, 4, 500))
    settings = boosting.BoostSettings(iterations=4, depth=depth, leaves=leaves, min_leaf=20)
    rows = [(*map(float, a), float(b)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    one = boosting.fit(df, ["a", "b", "c"], "y", "squared", settings)
    margin, trees = grown(x, y, settings)
    sizes = [sorted(r[8] for r in one.rows if r[0] == t and r[2] is None) for t in range(4)]
    assert sizes == trees
    got = [r["m"] for r in df.repartition(1).select("*", one.margin().alias("m")).orderBy("a", "b", "c", "y").collect()]
    order = sorted(range(500), key=lambda i: rows[i])
    assert got == pytest.approx(margin[order], abs=1e-3)
    again = boosting.fit(df.repartition(5), ["a", "b", "c"], "y", "squared", settings)
    assert again.rows == one.rows  # whatever way the rows are dealt


def test_boosting_of_few_or_no_rows(spark):
    schema = "a double, y double"
    none = boosting.fit(spark.createDataFrame([], schema), ["a"], "y", "squared", boosting.BoostSettings(iterations=2))
    assert [r[0] for r in none.rows] == [-1]
    few = boosting.fit(spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (3.0, None)], schema), ["a"], "y", "log", boosting.BoostSettings(iterations=2))
    p = spark.createDataFrame([(None,), (float("nan"),), (5.0,)], "a double").select(few.output().alias("p")).collect()
    assert all(r["p"] > 0.999 for r in p)


def test_many_values_share_bins_of_equal_rows(spark):
    edges = boosting.bin_edges(spark.range(5000).select(F.col("id").cast("double").alias("a")), ["a"], 255)[0]
    assert len(edges) == 254 and edges == sorted(edges)
    assert {round(b - a) for a, b in zip(edges, edges[1:])} == {19, 20}


def test_importance_pairs_every_test_row(spark, parts):
    _, test, stats = parts
    rows = features.add_features(test, stats)
    seen = []

    def scorer(f):
        seen.append(set(f))
        return f["scheduled_departure_hour"] * 1.0

    values = {r["feature"]: r["importance"] for r in models.permutation_importance(scorer, rows).collect()}
    assert seen == [set(FEATURE_COLUMNS)]
    assert values.pop("scheduled_departure_hour") == 1.0 and not any(values.values())
    assert "sample" not in inspect.signature(models.permutation_importance).parameters


def test_fallback_drivers(spark, parts):
    _, test, stats = parts
    report = score.score_report(score.score(test, stats), ["flight_number"])
    for importance in (None, models.fallback_importance(spark).limit(0)):
        row = score.with_drivers(report, importance).first()
        assert [(d["feature"], d["importance"]) for d in row["top_delay_drivers"]] == [(c, 0.1) for c in FEATURE_COLUMNS[:4]]


def test_newest_complete_run_is_loaded(spark, parts, tmp_path):
    path = str(tmp_path / "runs")
    assert models.load_run(spark, path) is None
    _, _, stats = parts
    tree = models.Ensemble("log", [(-1, 1, None, None, None, None, 0.25, None, 0)])
    assert models.save_run(models.TrainingRun(stats, tree, None), path) == 1
    half = files.next_version(spark, path)  # a writer that dies before its last write
    features.save_stats(stats, f"{path}/version={half}/stats")
    found = models.load_run(spark, path)
    assert (half, found.version, found.regressor, found.metrics) == (2, 1, None, None)
    assert found.classifier.rows == tree.rows
    metrics = spark.createDataFrame([("m", "mae", 1.5)], "model string, metric string, value double")
    assert models.save_run(models.TrainingRun(stats, None, tree, metrics=metrics), path) == 3
    newest = models.load_run(spark, path)
    assert (newest.version, newest.classifier, newest.metrics.first()["value"]) == (3, None, 1.5)


def test_queries_use_the_published_settings():
    used = models.BoostSettings()
    assert (used.iterations, used.depth, used.leaves, used.rate, used.min_leaf) == (100, 6, 31, 0.08, 30)
    assert Workspace.settings == used


def test_scores_are_bounded_and_tiered(parts):
    _, test, stats = parts
    rows = score.score_report(score.score(test, stats), ["flight_number"]).collect()
    for row in rows:
        p = row["delay_probability"]
        assert 0.04 <= p <= 0.90 and row["estimated_delay_minutes"] >= 0
        assert row["risk_level"] == ("low" if p < 0.2 else "moderate" if p < 0.4 else "high")
        assert f"{round(100 * p)}%" in row["interpretation"] or abs(100 * p % 1 - 0.5) < 0.02


def test_multipliers_clamp(spark):
    rows = spark.createDataFrame(
        [(0, 0, 0, False), (5, 1, 1, True), (30, 9, 99, False)],
        "scheduled_departure_hour int, day_of_week int, distance_group int, is_weekend boolean",
    )
    found = score.multipliers(rows).select(
        "hour_multiplier", "weekday_multiplier", "distance_multiplier", "weekend_multiplier"
    ).collect()
    assert [tuple(r) for r in found] == [
        (0.55, 0.92, 0.72, 1.0), (0.55, 0.92, 0.72, 1.05), (1.05, 1.18, 1.16, 1.0),
    ]


def test_heuristic_score_of_known_flight(spark, parts):
    _, _, stats = parts
    flight = spark.createDataFrame(
        [("?", "?-?", 11, 4, 5, False)],
        "reporting_airline_code string, route_code string, scheduled_departure_hour int, "
        "day_of_week int, distance_group int, is_weekend boolean",
    )
    row = score.score(flight, stats).first()
    assert row["delay_probability"] == pytest.approx(min(0.9, stats.global_rate * 0.95))
    assert row["estimated_delay_minutes"] == pytest.approx(stats.global_delay * 0.95)


def test_a_pass_of_boosting_is_one_small_job(spark):
    """A level of a tree costs one job of one stage, whatever came before it."""
    df = spark.range(4000).select((F.col("id") % 97).alias("a"), (F.col("id") % 31).alias("b"), (F.col("id") % 13 * 1.5).alias("y"))
    settings = boosting.BoostSettings(iterations=8, depth=3, leaves=8, min_leaf=20)
    spark.sparkContext.setJobGroup("boost", "one fit")
    boosting.fit(df, ["a", "b"], "y", "squared", settings)
    spark.sparkContext.setJobGroup("other", "")
    tracker = spark.sparkContext.statusTracker()
    stages = [len(tracker.getJobInfo(job).stageIds) for job in tracker.getJobIdsForGroup("boost")]
    assert sum(stages) <= settings.iterations * settings.depth + 20


def test_a_large_ensemble_is_walked_and_adds_as_its_expression(spark):
    rows = [(-1, 1, None, None, None, None, 0.1, None, 0)]
    for t in range(boosting.EXPRESSION_NODES // 3 + 5):
        rows.append((t, 1, "ab"[t % 2], t / 7, 2, 3, 0.0, None, 0))
        rows += [(t, 2, None, None, None, None, 0.3 / (t + 1), None, 0), (t, 3, None, None, None, None, -0.7 / (t + 2), None, 0)]
    large = boosting.Ensemble("log", rows)
    df = spark.createDataFrame(
        [(None, 1.0), (float("nan"), 2.0), (3.0, None), (float("-inf"), 9.5), (4 / 7, 5 / 7)], "a double, b double"
    )
    got = df.select(large.margin().alias("m"), large.margin({"a": F.col("b") * 2}).alias("n"))
    assert len(got._jdf.queryExecution().analyzed().toString()) < 5000
    kept, boosting.EXPRESSION_NODES = boosting.EXPRESSION_NODES, 10**9
    try:
        nested = df.select(large.margin().alias("m"), large.margin({"a": F.col("b") * 2}).alias("n")).collect()
    finally:
        boosting.EXPRESSION_NODES = kept
    assert got.collect() == nested


def test_a_feature_that_moves_no_prediction_has_no_importance(spark, parts):
    """Rounding errors of sums are no loss, however small all losses are."""
    _, test, stats = parts
    many = test.crossJoin(spark.range(400)).withColumn("flight_number", F.col("id").cast("int")).drop("id")
    rows = features.add_features(many, stats).withColumn(features.TARGET_MINUTES, 1000 + F.rand(5))
    found = models.permutation_importance(lambda f: f["day_of_week"] * 0.0 + 0.1, rows).collect()
    assert len(found) == len(FEATURE_COLUMNS) and not any(r["importance"] for r in found)


def test_features_that_follow_from_another_are_not_counted(spark):
    """Bins of an hour bring those of its sine and its peak flag; the sums are those of a direct count."""
    rng = np.random.default_rng(4)
    bins = rng.integers(0, [24, 5, 7], (3000, 3))
    bins = np.concatenate([bins, bins[:, :1] % 2, (bins[:, :1] + 3) % 24], 1).astype(np.uint8)
    n, y = rng.integers(1, 4, 3000), rng.integers(-(10**6), 10**6, 3000)
    blocks = spark.sparkContext.parallelize([(bins[i::4], n[i::4], y[i::4], np.zeros(len(n[i::4]))) for i in range(4)], 3)
    columns = boosting._columns(blocks, [24, 5, 7, 2, 24])
    assert [c for c, _ in columns.counted] == [0, 1, 2] and {b: a for b, (a, _) in columns.followed.items()} == {3: 0, 4: 0}
    found = boosting._histograms(blocks, boosting.Tree({1: boosting.Node(1, 0, 0.0)}), [1], "squared", columns, boosting.BoostSettings())[0]
    for f in range(5):
        for b in range(24):
            at = bins[:, f] == b
            assert found[:, f, b].tolist() == [n[at].sum(), -y[at].sum(), n[at].sum() * boosting.UNITS["squared"]]


def test_a_tree_of_many_leaves_is_walked_by_bits(spark):
    """More leaves than a word has bits, values at and between thresholds, null and NaN."""
    rows = [(-1, 1, None, None, None, None, 0.5, None, 0)]
    for t in range(3):
        rows += [(t, k, "ab"[k % 2], float((k * 37) % 64), 2 * k, 2 * k + 1, 0.0, None, 0) for k in range(1, 64)]
        rows += [(t, k, None, None, None, None, k / (t + 3), None, 0) for k in range(64, 128)]
    large = boosting.Ensemble("squared", rows)
    df = spark.range(3000).select((F.col("id") % 65).cast("double").alias("a"), F.when(F.col("id") % 7 > 0, F.col("id") * 0.37 % 64).alias("b"))
    df = df.unionByName(spark.createDataFrame([(float("nan"), 1.0), (None, None)], "a double, b double"))
    kept, boosting.EXPRESSION_NODES = boosting.EXPRESSION_NODES, 10**9
    try:
        nested = df.select(large.margin().alias("m")).collect()
    finally:
        boosting.EXPRESSION_NODES = kept
    boosting.EXPRESSION_NODES, size = 1, boosting.EXPRESSION_NODES
    try:
        assert df.select(large.margin().alias("m")).collect() == nested
    finally:
        boosting.EXPRESSION_NODES = size


def test_residuals_and_importance_fit_no_classifier(spark, monkeypatch):
    """A query of one model does not wait for the other, and shows what the saved run holds."""
    monkeypatch.setattr(Workspace, "settings", boosting.BoostSettings(iterations=2))
    monkeypatch.setattr(Workspace, "_open", {})
    sf, found = "/root/testdata/sf0.001", {}
    with monkeypatch.context() as alone:
        alone.setattr(models, "fit_classifier", None)
        for name in ("ml_gbt_residuals", "ml_perm_importance"):
            found[name] = sorted(QUERIES[name](spark, sf).collect())
    run = Workspace.of(spark, sf).run
    assert found == {"ml_gbt_residuals": sorted(run.residuals.collect()), "ml_perm_importance": sorted(run.importance.collect())}
    assert sorted(QUERIES["ml_gbt_tiers"](spark, sf).collect()) == sorted(run.metrics.collect())


def test_both_models_share_their_cells(spark, monkeypatch):
    """Flights are binned and dealt once for both, and the models are those of separate fits."""
    settings, written, write = boosting.BoostSettings(iterations=2), [], boosting.staged
    monkeypatch.setattr(Workspace, "settings", settings)
    monkeypatch.setattr(Workspace, "_open", {})
    monkeypatch.setattr(boosting, "staged", lambda df, name: written.append(name) or write(df, name))
    ws = Workspace.of(spark, "/root/testdata/sf0.001")
    ws.fit_both()
    assert written == ["boost_cells"]
    assert ws.regressor == models.fit_regressor(ws.train_features, settings)
    assert ws.classifier == models.fit_classifier(ws.train_features, settings)
