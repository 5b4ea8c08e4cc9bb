"""Shape of the physical plans that matter at scale."""

from __future__ import annotations

import re

import pytest

from flightlake.catalog import Workspace
from flightlake.ml import features
from flightlake.operators import standard
from flightlake.plans import dashboard, views

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ws(spark):
    return Workspace.of(spark, SF)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    """Plan with complete scan details."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def read_schemas(df) -> list[str]:
    return re.findall(r"ReadSchema: struct<([^>]*)>", formatted(df))


def test_star_joins_are_broadcast_by_size(ws):
    text = plan(views.flight_detail(ws.star))
    assert text.count("BroadcastHashJoin") == 4
    assert "SortMergeJoin" not in text


def test_large_dimensions_are_not_broadcast(ws, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan(views.flight_detail(ws.star))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_views_aggregate_before_joining(ws):
    text = plan(views.airline_performance(ws.star))
    # the join sits above the final aggregate, so fact rows are never joined
    assert text.index("BroadcastHashJoin") < text.index("ObjectHashAggregate")
    assert text.count("Join") == 1


def test_scans_are_pruned(ws):
    hours = read_schemas(views.departure_hour_performance(ws.star))
    assert len(hours) == 1
    assert {c.split(":")[0] for c in hours[0].split(",")} == {
        "scheduled_departure_hour", "arrival_delay_minutes_signed", "arrival_on_time", "flight_status",
    }


def test_filters_reach_the_scan(ws):
    text = formatted(dashboard.carrier_ranking(dashboard.filtered(ws.clean, ["C01"])))
    assert "PushedFilters" in text
    assert "EqualTo(reporting_airline_code,C01)" in text
    assert "EqualTo(flight_status,Completed)" in text


def test_month_filter_prunes_partitions(ws, spark):
    rows = spark.read.parquet(ws.clean_path).filter("year = 1998 AND month = 6")
    assert re.search(r"PartitionFilters: \[[^\]]*year", plan(rows))


@pytest.mark.parametrize("build", [
    lambda ws: standard.clean_standard(ws.raw, enforce=False),
    lambda ws: features.add_features(ws.test, ws.stats),
    lambda ws: views.flight_detail(ws.star),
    lambda ws: views.route_performance(ws.star),
    lambda ws: dashboard.daily_trend(ws.clean),
])
def test_no_fact_sized_single_partition(ws, build):
    text = plan(build(ws))
    assert "SinglePartition" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "ArrowEvalPython" not in text


def test_cleaning_shuffles_once(ws):
    assert plan(standard.clean_standard(ws.raw, enforce=False)).count("Exchange ") == 1


def test_deduplication_combines_before_the_shuffle(ws):
    text = plan(ws.raw.dropDuplicates())
    exchange = text.index("Exchange hashpartitioning")
    assert "HashAggregate" in text[:exchange] and "HashAggregate" in text[exchange:]


def test_clean_table_files_are_sorted_by_range(ws, spark):
    """Dense keys rest on sorted, non-overlapping files."""
    table = spark.read.parquet(ws.clean_path)
    ranges = (
        table.selectExpr("_metadata.file_path AS f", "flight_date")
        .groupBy("f")
        .agg({"flight_date": "min"})
        .count()
    )
    assert ranges >= table.select("year", "month").distinct().count()
