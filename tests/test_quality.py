"""Raw and clean suites, profile, file sources."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flightlake.operators import duplicates
from flightlake.operators.clean import clean_flights
from flightlake.operators.duplicates import duplicate_counts
from flightlake.quality import profile
from flightlake.quality.clean import validate_clean
from flightlake.quality.raw import validate_raw
from flightlake.quality.rules import overall, require_pass
from flightlake.sources import files


def failures(results):
    return {r["rule_name"]: r["failed_row_count"] for r in results.collect() if r["status"] != "PASS"}


def test_sound_rows_pass_both_suites(raw):
    source = raw({}, dict(OP_CARRIER_FL_NUM="2"))
    results = validate_raw(source)
    assert (results.count(), failures(results)) == (27, {})
    results = validate_clean(clean_flights(source))
    assert (results.count(), failures(results)) == (17, {})
    assert overall(results).first()["overall_status"] == "PASS"


def test_raw_suite_counts_faults(raw):
    source = raw(
        {}, {}, dict(OP_CARRIER_FL_NUM="2", MONTH=None), dict(OP_CARRIER_FL_NUM="3", TAXI_OUT="-1"),
        dict(OP_CARRIER_FL_NUM="4", ARR_DEL15="1"), dict(OP_CARRIER_FL_NUM="5", CANCELLED="1"),
    )
    assert failures(validate_raw(source)) == {
        "month_matches_flight_date": 1,
        "selected_period": 1,
        "no_exact_duplicate_rows": 1,
        "unique_flight_keys": 2,
        "non_negative_measurements": 1,
        "arrival_delay_indicator_consistent": 1,
        "cancelled_flights_have_reason": 1,
    }
    with pytest.raises(RuntimeError, match="6 critical"):
        require_pass(validate_raw(source), "Raw suite")


def test_missing_column_ends_the_suites_early(raw):
    results = validate_raw(raw().drop("DEST"))
    assert failures(results) == {"required_columns_present": 1} and results.count() == 1
    clean = clean_flights(raw()).drop("is_weekend")
    assert failures(validate_clean(clean)) == {"required_columns_present": 1}


def test_empty_clean_table_fails(raw):
    results = validate_clean(clean_flights(raw()).limit(0))
    assert failures(results) == {"dataset_is_not_empty": 1}


def test_warnings_do_not_fail(raw):
    results = validate_raw(raw(dict(DEST_AIRPORT_ID="10721")))
    assert overall(results).first()["overall_status"] == "PASS WITH WARNINGS"
    require_pass(results, "Raw suite")


def test_duplicate_counts_against_brute_force(spark):
    rows = [(k % 7 if k % 5 else None, k % 3, k % 2) for k in range(60)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    full = [rows.count(r) for r in set(rows)]
    keys = [r[:2] for r in rows]
    by_key = [keys.count(k) for k in set(keys)]
    assert list(duplicate_counts(df, ["a", "b"]).first()) == [
        sum(n - 1 for n in full), sum(n for n in by_key if n > 1), sum(n > 1 for n in by_key),
    ]


def test_rows_that_share_a_digest_are_compared(spark, monkeypatch):
    """Nulls in other places, -0.0 and NaN; a digest that all rows share changes no count."""
    nan = float("nan")
    rows = [(1, None, "x", 0.0), (1, "x", None, -0.0), (1, None, "x", -0.0), (2, "y", "y", nan), (2, "y", "y", nan), (3, "z", "z", None)]
    df = spark.createDataFrame(rows, "k int, a string, b string, v double")
    assert list(duplicate_counts(df, ["k"]).first()) == [2, 5, 2]
    monkeypatch.setattr(duplicates, "row_digest", lambda df: {"_digest1": F.lit(1), "_digest2": F.lit(2)})
    assert list(duplicate_counts(df, ["k"]).first()) == [2, 5, 2]


def test_profile_types_follow_the_values(spark):
    df = spark.createDataFrame(
        [("1", "1", "1.5", "x", None), ("2", None, "2", "3", None)], "a string, b string, c string, d string, e string"
    )
    kinds = {r["column_name"]: r["data_type"] for r in profile.column_types(df).collect()}
    assert kinds == {"a": "int64", "b": "float64", "c": "float64", "d": "object", "e": "float64"}


def test_profile_schema_diff_and_missing(raw):
    source = raw().drop("TAIL_NUM").withColumnRenamed("DEST", "EXTRA")
    found = {r["column_name"]: r["finding"] for r in profile.schema_diff(source).collect()}
    assert found == {"TAIL_NUM": "missing", "DEST": "missing", "EXTRA": "unexpected"}
    assert profile.schema_diff(raw()).count() == 0
    first = profile.missing_values(raw({}, dict(TAXI_IN=None))).collect()
    gaps = {r["column_name"]: r["missing_percentage"] for r in first}
    assert (gaps["TAXI_IN"], gaps["CARRIER_DELAY"], gaps["YEAR"]) == (50.0, 100.0, 0.0)


def test_csv_discovery_and_reading(spark, raw, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.find_raw_files(spark, str(tmp_path))
    source = raw({}, dict(OP_CARRIER_FL_NUM="2", ORIGIN_CITY_NAME='Say "hi", NY'))
    source.coalesce(1).write.option("header", True).csv(str(tmp_path / "plain"))
    folder = str(tmp_path / "plain")
    assert files.find_raw_files(spark, folder).endswith("*.csv")
    back = files.read_csv(spark, files.find_raw_files(spark, folder))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, source.collect()), key=repr)
    source.coalesce(1).write.option("header", True).csv(str(tmp_path / "named" / "flights.csv"))
    assert files.find_raw_files(spark, str(tmp_path / "named")).endswith("flights.csv")


def test_report_sink(spark, raw, tmp_path):
    path = str(tmp_path / "report")
    files.write_report_csv(validate_raw(raw()), path)
    assert spark.read.option("header", True).csv(path).count() == 27


def test_parquet_fallback(spark, raw, tmp_path):
    second = str(tmp_path / "second")
    raw().write.parquet(second)
    assert files.read_parquet(spark, str(tmp_path / "first"), second).count() == 1
    with pytest.raises(FileNotFoundError):
        files.read_parquet(spark, str(tmp_path / "first"))


def test_month_sketches_unite(spark, tmp_path):
    rows = [(2024, m, n % 7, n, n, f"r{n % 50}", n + 1000 * (m > 1)) for m in (1, 2, 3) for n in range(1000)]
    schema = "year int, month int, reporting_airline_id int, origin_airport_id int, destination_airport_id int, route_code string, flight_number bigint"
    path = str(tmp_path / "months")
    profile.write_month_profiles(spark.createDataFrame(rows, schema), path)
    months = spark.read.parquet(path)
    assert months.count() == 3

    def found(first, last):
        return {r["metric"]: r["estimate"] for r in profile.period_profile(months, first, last).collect()}

    year = found((2024, 1), (2024, 3))
    assert (year["flights"], year["reporting_airline_id"], year["route_code"]) == (3000, 7, 50)
    for metric, exact in (("origin_airport_id", 1000), ("flight_number", 2000)):
        assert abs(year[metric] - exact) <= 3 * profile.SKETCH_ERROR * exact
    assert found((2024, 2), (2024, 2))["flights"] == 1000
    assert not any(found((2025, 1), (2025, 12)).values())


def test_profiles_of_one_pass_write_no_table_first(spark):
    from flightlake.catalog import QUERIES, Workspace

    fresh = "/root/testdata/sf0.001/."  # a name that no other test has opened
    alone = {name: QUERIES[name](spark, fresh).collect() for name in ("profile_missing", "profile_flights")}
    ws = Workspace.of(spark, fresh)
    assert "edge" not in vars(ws)
    assert ws.edge.columns == ws.edge_once.columns and ws.edge_once is ws.edge
    assert alone == {name: QUERIES[name](spark, fresh).collect() for name in alone}


def test_one_pass_over_the_faulted_rows_writes_no_table_of_them(spark, tmp_path):
    from flightlake.catalog import QUERIES, Workspace

    fresh = tmp_path / "sf0.001"
    fresh.symlink_to("/root/testdata/sf0.001")
    names = ("required_null_counts", "dq_constraints_edge")
    once = [sorted(map(tuple, QUERIES[name](spark, str(fresh)).collect())) for name in names]
    ws = Workspace.of(spark, str(fresh))
    assert not {"edge", "edge_clean"} & set(vars(ws))
    assert ws.edge_clean.columns == ws.edge_clean_once.columns and ws.edge_clean_once is ws.edge_clean
    assert once == [sorted(map(tuple, QUERIES[name](spark, str(fresh)).collect())) for name in names]
