"""Named queries over the driver tables, one per operator of the inventory."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake import contracts as K
from flightlake.functions import casts, times
from flightlake.functions.metrics import count_where, rounded
from flightlake.ml import baselines, evaluate, features, models, score
from flightlake.operators import clean as cleaning
from flightlake.operators import compact, standard
from flightlake.operators.ranks import dense_keys
from flightlake.plans import dashboard, views
from flightlake.quality import profile, rules
from flightlake.quality.clean import validate_clean
from flightlake.quality.raw import validate_raw
from flightlake.session import spread, stage_path, staged, tune
from flightlake.sources import driver_tables, files
from flightlake.streaming import incremental
from flightlake.streaming.incremental import new_facts
from flightlake.warehouse import checks, dimensions, fact, load

Query = Callable[[SparkSession, str], DataFrame]


class Workspace:
    """Stage tables derived from one directory of driver tables.

    The same hand-over points as in production: raw landing tables, the clean
    table, the star schema, the fitted statistics.  Each is written once per
    application to the shared stage folder and read from there.
    """

    _open: dict[tuple[str, str], "Workspace"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tune(spark), sf_dir
        spread(self.spark, files.path_bytes(spark, f"{sf_dir}/lineitem.parquet"))

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Workspace":
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._open:
            cls._open[key] = cls(spark, sf_dir)
        return cls._open[key]

    @cached_property
    def raw(self) -> DataFrame:
        return staged(driver_tables.standard_flights(self.spark, self.sf_dir), "raw")

    @cached_property
    def edge(self) -> DataFrame:
        return staged(driver_tables.edge_flights(self.spark, self.sf_dir), "edge")

    @property
    def edge_once(self) -> DataFrame:
        """The faulted rows for a query of one pass: a table written only for it would cost more than the pass."""
        return self.edge if "edge" in vars(self) else driver_tables.edge_flights(self.spark, self.sf_dir)

    @cached_property
    def compact(self) -> DataFrame:
        return staged(driver_tables.compact_flights(self.spark, self.sf_dir), "compact")

    @cached_property
    def clean_path(self) -> str:
        path = stage_path(self.spark, "clean")
        cleaning.publish_clean(self.raw, path)
        return path

    @cached_property
    def clean(self) -> DataFrame:
        return files.read_clean_table(self.spark, self.clean_path)

    @cached_property
    def edge_clean(self) -> DataFrame:
        """The faulted rows cleaned without gates, for the suites that count faults."""
        return staged(standard.clean_standard(self.edge, enforce=False), "edge_clean")

    @property
    def edge_clean_once(self) -> DataFrame:
        """`edge_clean` for a query of one pass, which needs neither table of the faulted rows."""
        return self.edge_clean if "edge_clean" in vars(self) else standard.clean_standard(self.edge_once, enforce=False)

    @cached_property
    def star(self) -> load.Star:
        target = stage_path(self.spark, "warehouse")
        load.load_warehouse(self.spark, self.clean_path, target)
        return load.open_star(self.spark, target)

    @cached_property
    def busy_month(self) -> tuple[int, int]:
        """Year and month with the most flights, the first of equals; a clean table is not written only to count them."""
        clean = self.clean if "clean_path" in vars(self) else cleaning.clean_flights(self.raw)
        months = clean.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"))
        row = months.orderBy(F.desc("n"), "year", "month").first()
        return row["year"], row["month"]

    @cached_property
    def population(self) -> DataFrame:
        return features.population(self.clean)

    @cached_property
    def train(self) -> DataFrame:
        return features.train_rows(self.population)

    @cached_property
    def test(self) -> DataFrame:
        return features.test_rows(self.population)

    @cached_property
    def stats(self) -> features.FittedStats:
        return features.fit_stats(self.train)

    @cached_property
    def baselines(self) -> baselines.Baselines:
        return baselines.fit_baselines(self.train)

    settings = models.BoostSettings()

    @cached_property
    def train_features(self) -> DataFrame:
        return features.add_features(self.train, self.stats)

    @cached_property
    def test_features(self) -> DataFrame:
        return features.add_features(self.test, self.stats)

    @cached_property
    def cells(self) -> models.Cells:
        return models.training_cells(self.train_features, self.settings)

    @cached_property
    def regressor(self) -> models.Ensemble:
        return models.fit_regressor(self.cells, self.settings)

    @cached_property
    def classifier(self) -> models.Ensemble:
        return models.fit_classifier(self.cells, self.settings)

    def fit_both(self) -> None:
        """Both models side by side: a pass of either leaves most cores idle on small tables."""
        self.cells, self.test_features  # made once, before both need them
        with ThreadPoolExecutor(2) as pool:
            for fitted in [pool.submit(getattr, self, name) for name in ("regressor", "classifier")]:
                fitted.result()

    @cached_property
    def boosted_minutes(self) -> DataFrame:
        """Test flights with the minutes of the boosted regressor; needs no classifier."""
        return staged(models.predict(self.regressor, self.test_scored, "model"), "boosted_minutes")

    @cached_property
    def boosted_metrics(self) -> DataFrame:
        self.fit_both()
        rows = self.boosted_minutes
        rated = staged(models.predict(self.classifier, rows, "model_rate"), "boosted")
        return _tiers(
            self,
            evaluate.regression_metrics(rows, features.TARGET_MINUTES, "model", "Boosted Delay Forecaster"),
            evaluate.classification_metrics(rated, features.TARGET_FLAG, "model_rate", "Boosted Delay Classifier"),
        )

    @cached_property
    def importance(self) -> DataFrame:
        return models.permutation_importance(self.regressor.output, self.test_features)

    @cached_property
    def residuals(self) -> DataFrame:
        return evaluate.residual_analysis(self.boosted_minutes, features.TARGET_MINUTES, "model")

    @cached_property
    def run(self) -> models.TrainingRun:
        """The training run of both models, saved as one version and loaded again."""
        self.fit_both()
        path = stage_path(self.spark, "training_runs")
        tables = {"metrics": self.boosted_metrics, "importance": self.importance, "residuals": self.residuals}
        models.save_run(models.TrainingRun(self.stats, self.classifier, self.regressor, **tables), path)
        return models.load_run(self.spark, path)

    @cached_property
    def test_scored(self) -> DataFrame:
        """Test flights with the predictions of the statistic tiers."""
        based = features.add_features(self.test, self.stats)
        return baselines.predict_heuristic(based, self.baselines).withColumns(
            {
                "naive": F.lit(self.baselines.global_median),
                "naive_rate": F.lit(self.baselines.global_rate),
            }
        )


QUERIES: dict[str, Query] = {}
STAR_VIEWS = list(views.VIEWS)


def query(name: str):
    def register(build: Callable[[Workspace], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return casts.public_types(build(Workspace.of(spark, sf_dir)))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        return build

    return register


_KEY = ["flight_number", "flight_date"]
_FIRST, _LAST = dt.date(1996, 1, 1), dt.date(1999, 12, 31)


# ---------------------------------------------------------------- sources and sinks


@query("src_csv_roundtrip")
def _(ws):
    """Raw rows written as CSV, discovered in their folder, read back as text."""
    folder = stage_path(ws.spark, "csv")
    ws.raw.write.option("header", True).csv(folder)
    return files.read_csv(ws.spark, files.find_raw_files(ws.spark, folder))


@query("src_pruned_scan")
def _(ws):
    return files.prune(ws.spark.read.parquet(ws.clean_path))


@query("sink_parquet_roundtrip")
def _(ws):
    """Cleaned rows go straight into the sink and are read back; no other clean table is needed for that."""
    path = stage_path(ws.spark, "sink")
    files.write_clean_table(cleaning.clean_flights(ws.raw), path)
    return files.read_clean_table(ws.spark, path)


@query("clean_dispatch")
def _(ws):
    """Both layouts through the one entry point."""
    parts = [
        cleaning.clean_flights(raw)
        .groupBy("flight_status")
        .agg(F.count(F.lit(1)).alias("flights"))
        .select(F.lit(files.layout_of(raw)).alias("layout"), "flight_status", "flights")
        for raw in (ws.raw, ws.compact)
    ]
    return parts[0].unionByName(parts[1])


@query("clean_summary")
def _(ws):
    return cleaning.clean_summary(ws.edge, ws.edge_clean)


# ---------------------------------------------------------------- standard layout


@query("contract_missing_columns")
def _(ws):
    """Contract columns that the compact layout lacks, with the rows affected."""
    diff = profile.schema_diff(ws.compact)
    return diff.filter(F.col("finding") == "missing").select("column_name", "affected_rows")


@query("clean_bts")
def _(ws):
    return cleaning.clean_flights(ws.raw)


@query("clean_edge")
def _(ws):
    return standard.clean_standard(ws.edge, enforce=False)


@query("parse_flight_date")
def _(ws):
    day = casts.flight_date(ws.edge, "FL_DATE")
    return ws.edge.groupBy("FL_DATE").agg(F.count(F.lit(1)).alias("flights")).select(
        "FL_DATE", day.alias("flight_date"), "flights"
    )


@query("trim_blank_null")
def _(ws):
    names = ["TAIL_NUM", "CANCELLATION_CODE", "ORIGIN"]
    return ws.edge.select(
        "OP_CARRIER_FL_NUM", *[casts.trimmed(F.col(c)).alias(c.lower()) for c in names]
    )


@query("safe_cast_int")
def _(ws):
    names = ["MONTH", "ORIGIN_AIRPORT_ID", "CANCELLED", "FLIGHTS", "DEP_TIME"]
    return ws.edge.select(
        "OP_CARRIER_FL_NUM",
        *[casts.safe_integer(ws.edge, c).alias(c.lower()) for c in names],
    )


@query("safe_cast_float")
def _(ws):
    names = ["TAXI_OUT", "DISTANCE", "ARR_DELAY", "CARRIER_DELAY"]
    return ws.edge.select(
        "OP_CARRIER_FL_NUM", *[casts.safe_float(ws.edge, c).alias(c.lower()) for c in names]
    )


@query("gate_counts")
def _(ws):
    return standard.gate_counts(standard.typed(ws.edge))


@query("hhmm_hour")
def _(ws):
    names = ["CRS_DEP_TIME", "CRS_ARR_TIME", "DEP_TIME", "ARR_TIME"]
    return ws.edge.select(
        "OP_CARRIER_FL_NUM",
        *[times.hhmm_hour(casts.number(ws.edge, c)).alias(f"{c.lower()}_hour") for c in names],
    )


@query("dedup_exact")
def _(ws):
    rows = standard.typed(ws.edge).drop(standard.UNSAFE)
    kept = rows.dropDuplicates().groupBy("month").agg(F.count(F.lit(1)).alias("kept_rows"))
    every = rows.groupBy("month").agg(F.count(F.lit(1)).alias("all_rows"))
    same = every["month"].eqNullSafe(kept["month"])
    return every.join(kept, same).select(
        every["month"], "all_rows", "kept_rows", (F.col("all_rows") - F.col("kept_rows")).alias("removed")
    )


@query("delay_causes")
def _(ws):
    return ws.clean.select(
        *_KEY, "delay_cause_reported", *K.CAUSE_COLUMNS, "total_reported_delay_minutes"
    )


@query("calendar_fields")
def _(ws):
    names = ["year", "quarter", "month", "day_of_month", "day_of_week", "is_weekend"]
    return ws.edge_clean.groupBy("flight_date", *names).agg(F.count(F.lit(1)).alias("flights"))


@query("flight_status")
def _(ws):
    groups = ["cancelled", "diverted", "flight_status", "arrival_delayed_15", "arrival_on_time"]
    return ws.edge_clean.groupBy(*groups).agg(F.count(F.lit(1)).alias("flights"))


@query("required_null_counts")
def _(ws):
    return standard.required_null_counts(ws.edge_clean_once)


@query("canonical_topn")
def _(ws):
    order = [*K.CANONICAL_ORDER, *[c for c in K.CLEAN_KEY if c not in K.CANONICAL_ORDER]]
    return ws.clean.orderBy(*order).select(*order, "route_code", "flight_status")


# ---------------------------------------------------------------- compact layout


@query("clean_compact")
def _(ws):
    return compact.clean_compact(ws.compact)


@query("clean_compact_month")
def _(ws):
    return (
        cleaning.clean_flights(ws.compact, month=1)
        .groupBy("year", "month", "flight_status")
        .agg(
            F.count(F.lit(1)).alias("flights"),
            F.sum(F.col("total_reported_delay_minutes").cast("double")).alias("delay_minutes"),
        )
    )


@query("lookup_airline")
def _(ws):
    codes = ws.compact.groupBy(casts.trimmed(F.col("AIRLINE")).alias("reporting_airline_code"))
    return compact.with_carrier(codes.agg(F.count(F.lit(1)).alias("flights")))


@query("lookup_airport")
def _(ws):
    codes = ws.compact.groupBy(casts.trimmed(F.col("ORIGIN_AIRPORT")).alias("origin_airport_code"))
    return compact.with_airport(codes.agg(F.count(F.lit(1)).alias("flights")), "origin")


@query("time_block")
def _(ws):
    hour = times.hhmm_hour(
        F.coalesce(casts.number(ws.compact, "SCHEDULED_DEPARTURE"), F.lit(0.0))
    )
    return (
        ws.compact.groupBy(hour.alias("hour"))
        .agg(F.count(F.lit(1)).alias("flights"))
        .select("hour", times.hour_block(F.col("hour")).alias("time_block"), "flights")
    )


_COMPACT_DELAYS = [
    f"{side}_{part}"
    for side in ("departure", "arrival")
    for part in ("delay_minutes_signed", "delay_minutes", "delayed_15")
]


@query("delay_derivation")
def _(ws):
    return compact.clean_compact(ws.compact).select(*_KEY, *_COMPACT_DELAYS)


@query("delay_causes_compact")
def _(ws):
    return compact.clean_compact(ws.compact).select(
        *_KEY, *K.CAUSE_COLUMNS, "total_reported_delay_minutes", "delay_cause_reported"
    )


@query("distance_group")
def _(ws):
    return (
        compact.clean_compact(ws.compact)
        .groupBy("distance_miles", "distance_group")
        .agg(F.count(F.lit(1)).alias("flights"))
    )


# ---------------------------------------------------------------- profile and suites


@query("profile_schema_diff")
def _(ws):
    return profile.schema_diff(ws.compact)


@query("profile_missing")
def _(ws):
    return profile.missing_values(ws.edge_once)


@query("profile_types")
def _(ws):
    return profile.column_types(ws.edge)


@query("profile_coverage")
def _(ws):
    return profile.date_coverage(ws.edge)


@query("profile_duplicates")
def _(ws):
    return profile.duplicates(ws.edge)


@query("profile_flights")
def _(ws):
    return profile.flight_volumes(ws.edge_once)


@query("profile_period")
def _(ws):
    """Distinct counts of four years, exact and from month sketches: is the estimate within three errors?"""
    path = stage_path(ws.spark, "month_profiles")
    profile.write_month_profiles(ws.clean, path)
    found = profile.period_profile(ws.spark.read.parquet(path), (_FIRST.year, 1), (_LAST.year, 12))
    inside = ws.clean.filter(F.col("flight_date").between(F.lit(_FIRST), F.lit(_LAST)))
    exact = inside.agg(F.count(F.lit(1)).alias("flights"), *[F.countDistinct(c).alias(c) for c in profile.SKETCHED])
    both = found.join(exact.unpivot([], exact.columns, "metric", "exact_count"), "metric")
    near = F.abs(F.col("estimate") - F.col("exact_count")) <= 3 * profile.SKETCH_ERROR * F.col("exact_count") + 1
    return both.select("metric", "exact_count", near.alias("within_bound"))


_RULE = ["rule_name", "severity", "status", "failed_row_count"]


@query("dq_raw")
def _(ws):
    return validate_raw(ws.edge, 1998, 6).select(*_RULE)


@query("dq_csv_roundtrip")
def _(ws):
    """Rule results written as one CSV file and read back with their types."""
    report = validate_raw(ws.edge, 1998, 6).select(*_RULE)
    folder = stage_path(ws.spark, "rules")
    files.write_report_csv(report, folder)
    return ws.spark.read.schema(report.schema).option("header", True).csv(folder)


@query("dq_overall")
def _(ws):
    return rules.overall(validate_raw(ws.edge, 1998, 6))


@query("dq_clean")
def _(ws):
    return validate_clean(ws.edge_clean, 1998, 6).select(*_RULE)


def corrupted(clean: DataFrame) -> DataFrame:
    """Derived columns broken on purpose, so that every consistency rule fires."""
    hour, status = F.col("scheduled_departure_hour"), F.col("flight_status")

    def broken(when, value, name):
        return F.when(when, value).otherwise(F.col(name))

    return clean.withColumns(
        {
            "route_code": broken(hour == 1, F.lit("?"), "route_code"),
            "is_weekend": broken(hour == 2, ~F.col("is_weekend"), "is_weekend"),
            "flight_status": broken((hour == 3) & (status == "Diverted"), F.lit("Lost"), "flight_status"),
            "arrival_on_time": broken(hour == 4, F.lit(None).cast("boolean"), "arrival_on_time"),
            "year": broken(hour == 5, F.col("year") + 1, "year"),
            "month": broken(hour == 6, F.lit(None).cast("int"), "month"),
            "scheduled_arrival_hour": broken(hour == 7, F.lit(None).cast("int"), "scheduled_arrival_hour"),
            "total_reported_delay_minutes": broken(
                hour == 8, F.col("total_reported_delay_minutes") + 1, "total_reported_delay_minutes"
            ),
        }
    )


@query("dq_clean_corrupted")
def _(ws):
    return validate_clean(corrupted(ws.clean), 1998, 6).select(*_RULE)


@query("dq_warehouse")
def _(ws):
    return checks.validate_warehouse(ws.clean, ws.star)


@query("dq_warehouse_mismatch")
def _(ws):
    """The faulted clean rows against the star of the sound ones; of the faulted ones only what is compared is kept."""
    faulted = standard.clean_by_digest(ws.edge, enforce=False).select(*checks.RECONCILED)
    return checks.validate_warehouse(staged(faulted, "edge_reconciled"), ws.star)


@query("dq_orphans")
def _(ws):
    """Foreign keys against dimensions without their last airline and airport."""
    star = ws.star
    last_line = star.dim_airline.agg(F.max("airline_key")).scalar()
    last_port = star.dim_airport.agg(F.max("airport_key")).scalar()
    torn = load.Star(
        star.dim_date,
        star.dim_airline.filter(F.col("airline_key") < last_line),
        star.dim_airport.filter(F.col("airport_key") < last_port),
        star.fact_flight,
    )
    return checks.orphan_counts(torn)


@query("dq_constraints")
def _(ws):
    return checks.check_constraints(ws.star).select(*_RULE)


@query("dq_constraints_edge")
def _(ws):
    """Row constraints on facts built from the faulted rows."""
    facts = fact.fact_rows(ws.edge_clean_once, ws.star.dim_airline, ws.star.dim_airport)
    return rules.run_rules(facts, checks.constraint_rules()).select(*_RULE)


# ---------------------------------------------------------------- warehouse


@query("dim_date")
def _(ws):
    return dimensions.date_dimension(ws.clean)


@query("dim_airline")
def _(ws):
    return dimensions.airline_dimension(ws.clean)


@query("dim_airport")
def _(ws):
    return dimensions.airport_dimension(ws.clean)


@query("dim_conflicts")
def _(ws):
    found = dimensions.conflicts(dimensions.airport_rows(ws.edge_clean), "airport_id")
    return found.filter("airport_id IS NOT NULL")


@query("dim_upsert")
def _(ws):
    """Airports of the compact layout merged into the published dimension."""
    known = ws.star.dim_airport.filter(F.col("airport_id") < 10010)
    incoming = dimensions.airport_rows(ws.clean).withColumn(
        "city_name", F.concat(F.lit("New "), F.col("city_name"))
    )
    return dimensions.upsert(known, incoming, "airport_id", "airport_key")


@query("fact_keys")
def _(ws):
    keyed, _ = dense_keys(ws.spark.read.parquet(ws.clean_path), files.ROW_ID, "flight_key")
    return keyed.select("flight_key", *K.CLEAN_KEY)


@query("wh_fact")
def _(ws):
    return ws.star.fact_flight.select("flight_key", *K.FACT_COLUMNS)


@query("load_counts")
def _(ws):
    return load.load_counts(ws.star)


@query("incr_new_facts")
def _(ws):
    """Facts of the whole batch that are missing from a warehouse without its last month."""
    facts = ws.star.fact_flight
    last = facts.agg(F.max(F.col("date_key"))).scalar()
    held = facts.filter(F.floor(F.col("date_key") / 100) < F.floor(last / 100))
    return new_facts(facts, held).select(*K.FACT_NATURAL_KEY)


@query("incr_ledger")
def _(ws):
    """The busiest month in three deliveries into an empty target: its first half, all of it, the first again.

    Each delivery is joined by content with the ledger and shown with what became of it.
    """
    target = stage_path(ws.spark, "increments")
    year, month = ws.busy_month
    # written once: the deliveries are fingerprinted and cleaned from it, ten passes that would each read all months
    whole = staged(ws.raw.filter((F.col("YEAR").cast("int") == year) & (F.col("MONTH").cast("int") == month)), "busy_month")
    half = whole.filter(F.col("DAY_OF_MONTH").cast("int") <= 15)
    deliveries = {"half": half, "corrected": whole, "renamed": half.orderBy(F.desc("OP_CARRIER_FL_NUM"))}
    told = []
    for name, rows in deliveries.items():
        told.append((name, incremental.load_batch(rows, target, year, month), incremental.fingerprint(rows)))
    found = ws.spark.createDataFrame(told, "delivery string, outcome string, fingerprint string")
    keys = load.open_star(ws.spark, target).fact_flight.agg(F.count(F.lit(1)).alias("facts"), F.max("flight_key").alias("top_key"))
    ledger = incremental.read_ledger(ws.spark, target).filter("status = 'complete'")
    return found.join(ledger, "fingerprint").join(keys).select(
        "delivery", "outcome", "reporting_year", "reporting_month", "source_row_count", "loaded_row_count", "facts", "top_key"
    )


@query("load_guard")
def _(ws):
    """A second full load is refused, a replacing one is not: what each attempt leaves."""
    target = stage_path(ws.spark, "guarded")
    told = []
    for step, replace in (("first", False), ("again", False), ("replace", True)):
        try:
            load.load_warehouse(ws.spark, ws.clean_path, target, replace)
            outcome = "loaded"
        except RuntimeError:
            outcome = "refused"
        current = load.published(ws.spark, target)
        told.append((step, outcome, current.version, current.rows("fact_flight")))
    return ws.spark.createDataFrame(told, "step string, outcome string, version int, fact_rows long")


# ---------------------------------------------------------------- views


def _register_view(name: str, build) -> None:
    query(name)(lambda ws: build(ws.star))


for _name, _build in views.VIEWS.items():
    _register_view(_name, _build)


# ---------------------------------------------------------------- dashboard

@query("dash_filtered")
def _(ws):
    """Two carriers from three origins in four years; and, with empty lists, everything in the first year."""
    columns = [*_KEY, "reporting_airline_code", "route_code", "flight_status"]
    carriers = [r[0] for r in dashboard.carrier_options(ws.clean).select("reporting_airline_code").collect()]
    origins = [r["origin_airport_code"] for r in dashboard.top_origins(ws.clean, 3).collect()]
    chosen = dashboard.filtered(ws.clean, carriers[:2], origins, _FIRST, _LAST)
    everything = dashboard.filtered(ws.clean, [], [], _FIRST, dt.date(_FIRST.year, 12, 31))
    return chosen.select(F.lit("chosen").alias("filter"), *columns).unionByName(
        everything.select(F.lit("empty lists").alias("filter"), *columns)
    )


@query("dash_options")
def _(ws):
    lines = dashboard.carrier_options(ws.clean).select(
        F.lit("carrier").alias("option"), F.col("reporting_airline_code").alias("value")
    )
    bounds = dashboard.date_bounds(ws.clean).unpivot(
        [], ["first_date", "last_date"], "option", "value"
    )
    return lines.unionByName(bounds.withColumn("value", F.col("value").cast("string")))


@query("dash_top_origins")
def _(ws):
    return dashboard.top_origins(ws.clean)


@query("dash_kpis")
def _(ws):
    return dashboard.kpis(ws.clean)


@query("dash_hour_cascade")
def _(ws):
    return dashboard.hour_cascade(ws.clean)


@query("dash_cause_breakdown")
def _(ws):
    return dashboard.cause_breakdown(ws.clean)


@query("dash_daily")
def _(ws):
    return dashboard.daily_trend(ws.clean)


@query("dash_carrier_ranking")
def _(ws):
    return dashboard.carrier_ranking(ws.clean)


@query("dash_top_hubs")
def _(ws):
    return dashboard.congested_hubs(ws.clean)


@query("dash_top_routes")
def _(ws):
    return dashboard.delayed_corridors(ws.clean)


@query("dash_carrier_preview")
def _(ws):
    return dashboard.carrier_preview(ws.clean)


@query("find_hub_buffers")
def _(ws):
    return dashboard.hub_buffers(ws.clean)


@query("find_padded_routes")
def _(ws):
    return dashboard.padded_routes(ws.stats.routes)


@query("find_reserve_carriers")
def _(ws):
    """Carriers above the median late share, found with it as the limit, beside all others."""
    every = dashboard.reserve_carriers(ws.clean, above_pct=-1.0)
    limit = every.agg(F.percentile("delay_rate_pct", 0.5)).first()[0]
    found = dashboard.reserve_carriers(ws.clean, above_pct=limit)
    others = every.join(found, "reporting_airline_code", "left_anti")
    return found.withColumn("reserve", F.lit(True)).unionByName(others.withColumn("reserve", F.lit(False)))


# ---------------------------------------------------------------- features and models


@query("ml_population")
def _(ws):
    return ws.population.select(*_KEY, "route_code", *[features.TARGET_FLAG, features.TARGET_MINUTES])


@query("ml_split_counts")
def _(ws):
    day = F.col("day_of_month")
    part = F.when(day <= K.TRAIN_LAST_DAY, "train").when(day >= K.TEST_FIRST_DAY, "test")
    return ws.population.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("flights"))


@query("ml_carrier_stats")
def _(ws):
    return ws.stats.carriers.select(
        "reporting_airline_code",
        "carrier_flights",
        rounded(F.col("carrier_historical_delay_rate"), 6).alias("carrier_historical_delay_rate"),
        rounded(F.col("carrier_avg_delay_minutes"), 6).alias("carrier_avg_delay_minutes"),
    )


@query("ml_route_stats")
def _(ws):
    return ws.stats.routes.select(
        "route_code",
        "route_flights",
        rounded(F.col("route_congestion_index"), 6).alias("route_congestion_index"),
        rounded(F.col("route_avg_delay_minutes"), 6).alias("route_avg_delay_minutes"),
    )


@query("ml_global_stats")
def _(ws):
    return ws.stats.totals.select(
        "flights",
        rounded(F.col("global_delay_rate"), 6).alias("global_delay_rate"),
        rounded(F.col("global_avg_delay"), 6).alias("global_avg_delay"),
    )


@query("ml_stats_roundtrip")
def _(ws):
    """Statistics saved, loaded again and shown with both levels."""
    path = stage_path(ws.spark, "stats")
    features.save_stats(ws.stats, path)
    loaded = features.load_stats(ws.spark, path)
    lines = loaded.carriers.select(
        F.lit("carrier").alias("level"),
        F.col("reporting_airline_code").alias("code"),
        rounded(F.col("carrier_historical_delay_rate"), 6).alias("rate"),
        rounded(F.col("carrier_avg_delay_minutes"), 6).alias("delay"),
    )
    routes = loaded.routes.select(
        F.lit("route").alias("level"),
        F.col("route_code").alias("code"),
        rounded(F.col("route_congestion_index"), 6).alias("rate"),
        rounded(F.col("route_avg_delay_minutes"), 6).alias("delay"),
    )
    return lines.unionByName(routes)


_FRACTIONS = [
    "carrier_historical_delay_rate", "carrier_avg_delay_minutes", "route_congestion_index",
    "route_avg_delay_minutes", "departure_hour_sin", "departure_hour_cos",
]


@query("ml_features")
def _(ws):
    rows = features.add_features(ws.test, ws.stats)
    return rows.select(
        *_KEY,
        *[
            rounded(F.col(c), 6).alias(c) if c in _FRACTIONS else F.col(c)
            for c in K.FEATURE_COLUMNS
        ],
    )


@query("ml_baselines")
def _(ws):
    return ws.baselines.summary.select(
        rounded(F.col("global_median"), 6).alias("global_median"),
        rounded(F.col("global_delay_rate"), 6).alias("global_delay_rate"),
    )


@query("ml_heuristic_pred")
def _(ws):
    return baselines.predict_heuristic(ws.test, ws.baselines).select(
        *_KEY, "route_code", "reporting_airline_code", "heuristic"
    )


def _regression_tiers(ws) -> list[DataFrame]:
    rows = ws.test_scored
    return [
        evaluate.regression_metrics(rows, features.TARGET_MINUTES, "naive", "Naive Global Median", True),
        evaluate.regression_metrics(
            rows, features.TARGET_MINUTES, "heuristic", "Route x Carrier Heuristic", True
        ),
    ]


@query("ml_regression_metrics")
def _(ws):
    first, second = _regression_tiers(ws)
    return first.unionByName(second)


@query("ml_classification_metrics")
def _(ws):
    rows = ws.test_scored
    naive = evaluate.classification_metrics(
        rows, features.TARGET_FLAG, "naive_rate", "Naive Rate Baseline"
    )
    route = evaluate.classification_metrics(
        rows, features.TARGET_FLAG, "route_congestion_index", "Route Congestion Index"
    )
    return naive.unionByName(route)


@query("ml_auc")
def _(ws):
    rows = ws.test_scored
    parts = [
        evaluate.auc(rows, features.TARGET_FLAG, c).select(
            F.lit(c).alias("score"), rounded(F.col("auc"), 6).alias("auc")
        )
        for c in ("route_congestion_index", "carrier_historical_delay_rate")
    ]
    return parts[0].unionByName(parts[1])


@query("ml_residuals")
def _(ws):
    return evaluate.residual_analysis(ws.test_scored, features.TARGET_MINUTES, "heuristic")


@query("ml_tier_comparison")
def _(ws):
    """Baseline tiers of both tasks in one long table."""
    return _tiers(ws)


def _tiers(ws, *more: DataFrame) -> DataFrame:
    """(model, metric, value) of the statistic tiers and of further metric rows."""
    parts = []
    for frame in _regression_tiers(ws):
        names = [c for c in frame.columns if c != "model"]
        parts.append(frame.unpivot(["model"], names, "metric", "value"))
    naive = evaluate.classification_metrics(
        ws.test_scored, features.TARGET_FLAG, "naive_rate", "Naive Rate Baseline"
    )
    for frame in (naive, *more):
        names = [c for c in frame.columns if c != "model"]
        parts.append(frame.unpivot(["model"], names, "metric", "value"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("ml_hist_first_tree")
def _(ws):
    """Splits, gains and leaf values of the first boosted tree for minutes."""
    first = models.fit_regressor(ws.train_features, models.BoostSettings(iterations=1)).table(ws.spark)
    return first.filter("tree = 0").select(
        "node", "feature", rounded(F.col("threshold"), 3).alias("threshold"), rounded(F.col("gain"), 2).alias("gain"),
        "n", rounded(F.col("value"), 6).alias("value"),
    )


@query("ml_gbt_reg")
def _(ws):
    metrics = evaluate.regression_metrics(
        models.predict(ws.regressor, ws.test_scored), features.TARGET_MINUTES, "model", "Boosted Delay Forecaster"
    )
    first, second = _regression_tiers(ws)
    return first.unionByName(second).unionByName(metrics)


@query("ml_gbt_cls")
def _(ws):
    rows = models.predict(ws.classifier, ws.test_scored)
    return evaluate.classification_metrics(
        rows, features.TARGET_FLAG, "model", "Boosted Delay Classifier"
    )


@query("ml_gbt_tiers")
def _(ws):
    """Both boosted tiers beside the statistic tiers, one line per model and metric."""
    return ws.boosted_metrics


@query("ml_gbt_residuals")
def _(ws):
    return ws.residuals


@query("ml_perm_importance")
def _(ws):
    """Importance of the boosted regressor over all test flights."""
    return ws.importance


@query("ml_rate_importance")
def _(ws):
    """Importance for a scorer made of fitted statistics alone."""
    return models.permutation_importance(_rate_scorer, ws.test_features)


def _rate_scorer(f: dict) -> Column:
    """Minutes from the statistics of route and carrier, more in the peak hours."""
    return 0.6 * f["route_avg_delay_minutes"] + 0.4 * f["carrier_avg_delay_minutes"] + 2.0 * f["is_peak_hour"]


@query("ml_top_drivers")
def _(ws):
    return models.top_drivers(ws.run.importance, ws.spark)


@query("ml_fallback_drivers")
def _(ws):
    """Drivers of a report whose model has no importance, shown for each risk level."""
    report = score.with_drivers(_report(ws), None)
    shown = F.concat_ws(";", F.transform("top_delay_drivers", lambda d: F.concat(d["feature"], F.lit("="), d["importance"])))
    return report.groupBy("risk_level", shown.alias("drivers")).agg(F.count(F.lit(1)).alias("flights"))


# Two small ensembles with fixed trees, so that SQL can walk the same nodes.
FIXED_TREES = {
    "squared": [
        (-1, 1, None, None, None, None, 4.0, None, 0),
        (0, 1, "route_avg_delay_minutes", 9.5, 2, 3, 0.0, None, 0),
        (0, 2, "scheduled_departure_hour", 11.5, 4, 5, 0.0, None, 0),
        (0, 3, None, None, None, None, 5.25, None, 0),
        (0, 4, None, None, None, None, -6.5, None, 0),
        (0, 5, None, None, None, None, 1.5, None, 0),
        (1, 1, "carrier_avg_delay_minutes", 9.0, 2, 3, 0.0, None, 0),
        (1, 2, None, None, None, None, -2.0, None, 0),
        (1, 3, "departure_hour_sin", 0.25, 6, 7, 0.0, None, 0),
        (1, 6, None, None, None, None, 0.75, None, 0),
        (1, 7, None, None, None, None, 2.5, None, 0),
    ],
    "log": [
        (-1, 1, None, None, None, None, -1.0, None, 0),
        (0, 1, "route_congestion_index", 0.24, 2, 3, 0.0, None, 0),
        (0, 2, "day_of_week", 5.5, 4, 5, 0.0, None, 0),
        (0, 3, None, None, None, None, 0.9, None, 0),
        (0, 4, None, None, None, None, -0.8, None, 0),
        (0, 5, None, None, None, None, 0.2, None, 0),
        (1, 1, "is_peak_hour", 0.5, 2, 3, 0.0, None, 0),
        (1, 2, None, None, None, None, -0.3, None, 0),
        (1, 3, None, None, None, None, 0.6, None, 0),
    ],
}


def _fixed(ws, loss: str) -> models.Ensemble:
    """The fixed trees as they come back from their table."""
    return models.Ensemble.of_table(staged(models.Ensemble(loss, FIXED_TREES[loss]).table(ws.spark), "fixed_trees"))


@query("score_tree_minutes")
def _(ws):
    """Clipped minutes of a fixed node table for every test flight."""
    rows = models.predict(_fixed(ws, "squared"), ws.test_features, "minutes")
    return rows.select(*_REPORT_KEY, rounded(F.col("minutes"), 6).alias("minutes"))


@query("score_tree_blend")
def _(ws):
    """Delay probability, statistics 0.7 and a fixed node table 0.3, for every clean flight."""
    scored = score.score(ws.clean, ws.stats, _fixed(ws, "log"))
    return scored.select(*_REPORT_KEY, rounded(F.col("delay_probability"), 4).alias("delay_probability"))


@query("ml_run_roundtrip")
def _(ws):
    """A run of statistic tiers and fixed trees saved twice; what the loader finds in the newest version."""
    path = stage_path(ws.spark, "runs")
    fixed = {"classifier": _fixed(ws, "log"), "regressor": _fixed(ws, "squared")}
    tables = {
        "metrics": _tiers(ws),
        "residuals": evaluate.residual_analysis(ws.test_scored, features.TARGET_MINUTES, "heuristic"),
        "importance": models.fallback_importance(ws.spark),
    }
    models.save_run(models.TrainingRun(ws.stats, None, None), path)
    models.save_run(models.TrainingRun(ws.stats, **fixed, **tables), path)
    found = models.load_run(ws.spark, path)
    none = F.lit(None).cast("double")
    parts = [
        found.metrics.select(F.lit("metrics").alias("part"), F.concat_ws("/", "model", "metric").alias("name"), "value"),
        found.residuals.select(F.lit("residuals"), "metric", "value"),
        found.importance.select(F.lit("importance"), "feature", "importance"),
        found.stats.routes.select(F.lit("routes"), "route_code", rounded(F.col("route_congestion_index"), 6)),
        *[m.table(ws.spark).filter("feature IS NULL").select(F.lit(m.loss), F.concat_ws("/", "tree", "node"), "value") for m in (found.classifier, found.regressor)],
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part.toDF("part", "name", "value"))
    return out.withColumn("version", F.lit(found.version)).withColumn("value", F.coalesce("value", none))


# ---------------------------------------------------------------- scoring


@query("score_multipliers")
def _(ws):
    groups = ["scheduled_departure_hour", "day_of_week", "distance_group", "is_weekend"]
    found = ws.clean.groupBy(*groups).agg(F.count(F.lit(1)).alias("flights"))
    return score.multipliers(found)


_REPORT_KEY = ["flight_number", "flight_date", "reporting_airline_code", "route_code"]


def _report(ws) -> DataFrame:
    return score.score_report(score.score(ws.clean, ws.stats), _REPORT_KEY)


@query("score_blended")
def _(ws):
    return _report(ws).select(
        *_REPORT_KEY,
        "delay_probability",
        "delay_probability_pct",
        "estimated_delay_minutes",
        "risk_level",
        "cost_impact_usd",
    )


@query("score_factors")
def _(ws):
    return _report(ws).select(
        *_REPORT_KEY,
        "route_baseline_delay_min",
        "carrier_delta_pct",
        "hour_delta_pct",
        "dow_delta_pct",
        "hour_multiplier",
        "dow_multiplier",
    )


@query("score_interpretation")
def _(ws):
    return _report(ws).groupBy("risk_level", "interpretation").agg(F.count(F.lit(1)).alias("flights"))


@query("score_with_model")
def _(ws):
    """The whole report of the saved run: classifier blended in, its drivers beside each flight."""
    run = ws.run
    report = score.with_drivers(score.score_report(score.score(ws.clean, run.stats, run.classifier), _REPORT_KEY), run.importance)
    drivers = F.concat_ws(";", F.transform("top_delay_drivers", lambda d: F.concat(d["feature"], F.lit("="), d["importance"])))
    return report.withColumn("top_delay_drivers", drivers)


@query("score_risk_mix")
def _(ws):
    return (
        _report(ws)
        .groupBy("reporting_airline_code")
        .agg(*[count_where(F.col("risk_level") == t).alias(f"{t}_risk") for t in ("low", "moderate", "high")])
    )
