"""Content fingerprints and the comparison of one month."""

from __future__ import annotations

from flightlake.contracts import FACT_NATURAL_KEY
from flightlake.streaming.incremental import fingerprint, new_facts


def test_a_value_moved_between_null_columns_is_another_batch(spark):
    schema = "k string, weather string, security string"
    one = spark.createDataFrame([("x", "5", None), ("y", None, None)], schema)
    two = spark.createDataFrame([("x", None, "5"), ("y", None, None)], schema)
    assert fingerprint(one) != fingerprint(two)
    assert fingerprint(one) == fingerprint(one.repartition(3).orderBy("k", ascending=False))
    assert fingerprint(one) != fingerprint(one.withColumnRenamed("weather", "late"))


def test_other_months_are_pruned_by_literals(spark, tmp_path):
    columns = [*FACT_NATURAL_KEY, *[c for c in ("year", "month") if c not in FACT_NATURAL_KEY]]
    rows = spark.range(24).select(*[_column(c) for c in columns])
    rows.write.partitionBy("year", "month").parquet(str(tmp_path / "facts"))
    saved = spark.read.parquet(str(tmp_path / "facts"))
    batch = rows.filter("year = 2024 AND month = 3")
    plan = new_facts(batch, saved, (2024, 3))._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "2024" in filters and "3" in filters
    assert new_facts(batch, saved, (2024, 3)).isEmpty()


def _column(name):
    from pyspark.sql import functions as F

    if name == "year":
        return (F.lit(2023) + (F.col("id") / 12).cast("int")).alias(name)
    if name == "month":
        return (F.col("id") % 12 + 1).cast("int").alias(name)
    return F.col("id").cast("string").alias(name)


def test_incr_new_facts_takes_the_whole_batch_and_month(spark, monkeypatch):
    """The batch is every fact, and no day of the missing month is left out."""
    from flightlake import catalog

    seen = []
    monkeypatch.setattr(catalog, "new_facts", lambda facts, *held: seen.append((facts, held)) or new_facts(facts, *held))
    found = catalog.QUERIES["incr_new_facts"](spark, "/root/testdata/sf0.001")
    facts = catalog.Workspace.of(spark, "/root/testdata/sf0.001").star.fact_flight
    (batch, _), = seen
    assert batch.count() == facts.count()
    last = facts.agg({"date_key": "max"}).first()[0] // 100
    assert found.count() == facts.filter(f"date_key div 100 = {last}").count()


def test_incr_ledger_writes_no_clean_table(spark, tmp_path):
    """The busiest month is counted on cleaned rows as they come; with a clean table at hand it is the same."""
    from flightlake.catalog import QUERIES, Workspace

    fresh = tmp_path / "sf0.001"
    fresh.symlink_to("/root/testdata/sf0.001")
    found = QUERIES["incr_ledger"](spark, str(fresh)).collect()
    ws = Workspace.of(spark, str(fresh))
    assert "clean_path" not in vars(ws) and "busy_month" in vars(ws)
    assert {(r.reporting_year, r.reporting_month) for r in found} == {ws.busy_month}
    other = Workspace(spark, str(fresh))
    assert other.clean_path and other.busy_month == ws.busy_month
