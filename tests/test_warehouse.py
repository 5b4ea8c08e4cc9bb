"""Star schema, loading, reconciliation, increments."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flightlake.operators.clean import clean_flights, publish_clean
from flightlake.operators.ranks import dense_keys
from flightlake.operators.standard import clean_standard
from flightlake.plans import views
from flightlake.quality.rules import overall, require_pass
from flightlake.sources import files
from flightlake.streaming import incremental
from flightlake.warehouse import checks, dimensions, load
from flightlake.warehouse.fact import fact_rows

BACK = dict(
    FL_DATE="01/02/2024 12:00:00 AM", DAY_OF_MONTH="2", OP_CARRIER_FL_NUM="11",
    ORIGIN_AIRPORT_ID="14747", ORIGIN="SEA", ORIGIN_CITY_NAME="Seattle, WA",
    ORIGIN_STATE_ABR="WA", ORIGIN_STATE_NM="Washington", DEST_AIRPORT_ID="10721", DEST="BOS",
    DEST_CITY_NAME="Boston, MA", DEST_STATE_ABR="MA", DEST_STATE_NM="Massachusetts",
)


@pytest.fixture()
def published(spark, raw, tmp_path):
    """Two flights cleaned, loaded and published."""
    clean_path, target = str(tmp_path / "clean"), str(tmp_path / "warehouse")
    publish_clean(raw({}, BACK), clean_path)
    counts = load.load_warehouse(spark, clean_path, target)
    return clean_path, target, {r["table_name"]: r["row_count"] for r in counts.collect()}


def test_date_dimension(raw):
    rows = dimensions.date_dimension(clean_flights(raw({}, BACK))).orderBy("date_key").collect()
    assert [r["date_key"] for r in rows] == [20240101, 20240102]
    assert [r["day_name"] for r in rows] == ["Monday", "Tuesday"]
    assert rows[0]["month_name"] == "January"


def test_airline_dimension_rejects_conflicting_codes(raw):
    clean = clean_flights(raw({}, dict(OP_CARRIER_FL_NUM="2", OP_UNIQUE_CARRIER="ZZ")))
    with pytest.raises(ValueError, match="1 airline ids have several.*airline_conflicts"):
        dimensions.airline_dimension(clean)


def test_airport_dimension_joins_both_roles(raw):
    dimension = dimensions.airport_dimension(clean_flights(raw({}, BACK)))
    rows = dimension.orderBy("airport_key").select("airport_key", "airport_id").collect()
    assert [tuple(r) for r in rows] == [(1, 10721), (2, 14747)]


def test_airport_dimension_rejects_missing_code_and_conflicts(raw):
    clean = clean_standard(raw(dict(ORIGIN=None)), enforce=False)
    with pytest.raises(ValueError, match="no id or no code"):
        dimensions.airport_dimension(clean)
    with pytest.raises(ValueError, match="1 airport ids have several"):
        dimensions.airport_dimension(clean_flights(raw({}, dict(OP_CARRIER_FL_NUM="2", DEST="LAY"))))


def test_load_input_needs_required_values(spark, raw, tmp_path):
    clean = clean_standard(raw(dict(DISTANCE=None)), enforce=False)
    files.write_clean_table(clean, str(tmp_path / "clean"))
    with pytest.raises(ValueError, match="needs these values: distance_miles=1"):
        load.load_warehouse(spark, str(tmp_path / "clean"), str(tmp_path / "target"))
    with pytest.raises(ValueError, match="lacks columns of the warehouse"):
        load.validate_load_input(clean.drop("route_code"))


def test_fact_maps_surrogate_keys(spark, raw):
    clean = clean_flights(raw({}, BACK))
    airlines = spark.sql("SELECT 20409 AS reporting_airline_id, 7 AS airline_key")
    airports = spark.sql("SELECT * FROM VALUES (10721, 11), (14747, 12) AS t(airport_id, airport_key)")
    rows = fact_rows(clean, airlines, airports, enforce=True).orderBy("date_key").collect()
    assert [r["airline_key"] for r in rows] == [7, 7]
    assert [r["origin_airport_key"] for r in rows] == [11, 12]
    assert [r["destination_airport_key"] for r in rows] == [12, 11]
    with pytest.raises(ValueError, match="no dimension row"):
        fact_rows(clean, airlines, airports.filter("airport_id = 10721"), enforce=True)


def test_upsert_keeps_known_keys(spark):
    known = spark.sql("SELECT * FROM VALUES (1, 10, 'a'), (2, 20, 'b') AS t(k, id, name)")
    incoming = spark.sql("SELECT * FROM VALUES (20, 'B'), (5, 'new'), (30, 'x') AS t(id, name)")
    rows = dimensions.upsert(known, incoming, "id", "k").orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, 10, "a"), (2, 20, "B"), (3, 5, "new"), (4, 30, "x")]


def test_load_counts_and_views(spark, published):
    _, target, counts = published
    assert counts == {"dim_date": 2, "dim_airline": 1, "dim_airport": 2, "fact_flight": 2}
    star = load.open_star(spark, target)
    names = views.register_views(star)
    assert len(names) == 16
    assert spark.sql("SELECT count(*) FROM vw_flight_detail").first()[0] == 2
    assert spark.sql("SELECT total_flights FROM vw_overview_metrics").first()[0] == 2
    keys = star.fact_flight.orderBy("flight_key").select("flight_key", "date_key").collect()
    assert [tuple(r) for r in keys] == [(1, 20240101), (2, 20240102)]


def test_reload_guard_and_replace(spark, published):
    clean_path, target, _ = published
    with pytest.raises(RuntimeError, match="already holds 2 fact rows"):
        load.load_warehouse(spark, clean_path, target)
    counts = load.load_warehouse(spark, clean_path, target, replace=True)
    assert {r["table_name"]: r["row_count"] for r in counts.collect()}["fact_flight"] == 2
    assert load.open_star(spark, target).fact_flight.count() == 2


def test_warehouse_suite_finds_lost_rows(spark, published):
    clean_path, target, _ = published
    clean, star = spark.read.parquet(clean_path), load.open_star(spark, target)
    assert {r["status"] for r in checks.validate_warehouse(clean, star).collect()} == {"PASS"}
    torn = load.Star(
        star.dim_date, star.dim_airline, star.dim_airport, star.fact_flight.filter("flight_key = 1")
    )
    failed = {
        r["rule_name"] for r in checks.validate_warehouse(clean, torn).collect() if r["status"] == "FAIL"
    }
    assert failed == {"fact_flight_count", "completed_flight_count", "on_time_arrival_count"}
    require_pass(checks.check_constraints(star), "Constraints")
    doubled = load.Star(
        star.dim_date, star.dim_airline, star.dim_airport, star.fact_flight.union(star.fact_flight)
    )
    verdict = overall(checks.check_constraints(doubled)).first()
    assert (verdict["critical_failures"], verdict["overall_status"]) == (1, "FAIL")
    with pytest.raises(RuntimeError, match="1 critical rule failure"):
        require_pass(checks.check_constraints(doubled), "Constraints")


FEBRUARY = dict(FL_DATE="02/03/2024 12:00:00 AM", MONTH="2", DAY_OF_MONTH="3")


def test_increment_adds_new_facts_once(spark, raw, published):
    _, target, _ = published
    month = raw(FEBRUARY, {**FEBRUARY, **dict(OP_CARRIER_FL_NUM="7", DEST_AIRPORT_ID="1", DEST="AAA")})
    assert incremental.load_batch(month, target, 2024, 2) == "complete"
    star = load.open_star(spark, target)
    assert star.fact_flight.count() == 4
    assert star.fact_flight.select("flight_key").distinct().count() == 4
    assert star.dim_airport.count() == 3
    # known airports keep their key, the new one comes after
    assert star.dim_airport.filter("airport_id = 1").first()["airport_key"] == 3
    # the same content again, in another order, is known by its fingerprint
    assert incremental.load_batch(month.orderBy(F.desc("OP_CARRIER_FL_NUM")), target, 2024, 2) == "skipped"
    # a corrected file with one known and one new flight adds the new one only
    more = raw(FEBRUARY, {**FEBRUARY, "OP_CARRIER_FL_NUM": "9"})
    assert incremental.load_batch(more, target, 2024, 2) == "complete"
    assert load.open_star(spark, target).fact_flight.count() == 5
    ledger = incremental.read_ledger(spark, target).filter("status = 'complete'")
    assert sorted(r["loaded_row_count"] for r in ledger.collect()) == [1, 2]


def test_failed_increment_is_recorded_and_not_published(spark, raw, published):
    _, target, _ = published
    with pytest.raises(ValueError, match="outside 2024-03"):
        incremental.load_batch(raw(FEBRUARY), target, 2024, 3)
    with pytest.raises(ValueError, match="repeats a flight key"):
        incremental.load_batch(raw(FEBRUARY, {**FEBRUARY, "TAIL_NUM": "N9"}), target, 2024, 2)
    assert load.open_star(spark, target).fact_flight.count() == 2
    failed = incremental.read_ledger(spark, target).collect()
    assert {r["status"] for r in failed} == {"failed"}
    assert any("outside" in r["error_message"] for r in failed)


def test_stream_of_monthly_files(spark, raw, published, tmp_path):
    _, target, _ = published
    folder = str(tmp_path / "incoming")
    raw(FEBRUARY).coalesce(1).write.option("header", True).csv(folder)
    for _ in range(2):
        query = incremental.stream_folder(
            spark, folder, raw().schema, target, str(tmp_path / "checkpoint")
        )
        query.awaitTermination(120)
        assert query.exception() is None
    assert load.open_star(spark, target).fact_flight.count() == 3


def test_increment_of_known_flights_adds_nothing(spark, raw, published):
    """A retry after a crash between publishing and the ledger entry."""
    _, target, _ = published
    assert incremental.load_batch(raw({**BACK, "TAIL_NUM": "N7"}), target, 2024, 1) == "complete"
    assert load.open_star(spark, target).fact_flight.count() == 2
    assert incremental.read_ledger(spark, target).first()["loaded_row_count"] == 0


def test_first_batch_starts_a_warehouse(spark, raw, tmp_path):
    target = str(tmp_path / "empty")
    month = raw(*[dict(OP_CARRIER_FL_NUM=str(n), CRS_DEP_TIME=str(600 + n)) for n in range(1, 8)])
    assert incremental.load_batch(month, target, 2024, 1) == "complete"
    # a corrected month brings two flights, a renamed copy none
    more = raw(*[dict(OP_CARRIER_FL_NUM=str(n), CRS_DEP_TIME=str(600 + n)) for n in range(1, 10)])
    assert incremental.load_batch(more, target, 2024, 1) == "complete"
    assert incremental.load_batch(more.orderBy(F.desc("OP_CARRIER_FL_NUM")), target, 2024, 1) == "skipped"
    star = load.open_star(spark, target)
    assert sorted(r[0] for r in star.fact_flight.select("flight_key").collect()) == list(range(1, 10))
    ledger = incremental.read_ledger(spark, target).orderBy("loaded_at").collect()
    assert [(r["source_row_count"], r["loaded_row_count"]) for r in ledger] == [(7, 7), (9, 2)]
    require_pass(checks.check_constraints(star), "Constraints")


def test_one_publisher_wins_a_version(spark, raw, published, monkeypatch):
    clean_path, target, _ = published
    monkeypatch.setattr(load, "WAIT_SECONDS", 0.0)
    before = load.published(spark, target)
    load.publish(spark, target, 2, before.loads)
    with pytest.raises(load.VersionTaken):
        load.publish(spark, target, 2, before.loads)
    # an increment that read version 1 loses, reads again and builds on version 2
    seen, read = [], load.published

    def stale(spark, target):
        seen.append(1)
        return before if len(seen) == 1 else read(spark, target)

    monkeypatch.setattr(load, "published", stale)
    assert incremental.load_batch(raw(FEBRUARY), target, 2024, 2) == "complete"
    assert read(spark, target).version == 3 and load.open_star(spark, target).fact_flight.count() == 3
    # a claim whose writer died is reported
    assert files.create_exclusively(spark, f"{target}/_claims/version=4")
    with pytest.raises(RuntimeError, match="version 4 is claimed"):
        load.load_warehouse(spark, clean_path, target, replace=True)
    assert read(spark, target).version == 3


@pytest.mark.parametrize("cut", ["publish", "_record"])
def test_stream_is_taken_up_after_a_cut(spark, raw, published, tmp_path, monkeypatch, cut):
    """The stream dies before the manifest is written, or between manifest and ledger."""
    _, target, _ = published
    folder = str(tmp_path / "incoming")
    raw(FEBRUARY, {**FEBRUARY, "OP_CARRIER_FL_NUM": "8"}).coalesce(1).write.option("header", True).csv(folder)
    real, calls = getattr(incremental, cut), []

    def once(*args, **fields):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("cut")
        return real(*args, **fields)

    monkeypatch.setattr(incremental, cut, once)
    landings = []
    landed = incremental.landed
    monkeypatch.setattr(incremental, "landed", lambda batch, path: landings.append(files.path_exists(spark, path)) or landed(batch, path))
    for _ in range(2):
        query = incremental.stream_folder(spark, folder, raw().schema, target, str(tmp_path / "checkpoint"))
        try:
            query.awaitTermination(180)
        except Exception as error:
            assert "cut" in str(error)
    assert landings == [False, True]  # the source is read once, the replay takes what was landed
    assert load.open_star(spark, target).fact_flight.count() == 4
    done = [r for r in incremental.read_ledger(spark, target).collect() if r["status"] == "complete"]
    assert [r["loaded_row_count"] for r in done] == [2]


def test_keys_need_no_exchange_of_fact_rows(spark, raw, tmp_path):
    clean_path = str(tmp_path / "clean")
    publish_clean(raw(*[dict(OP_CARRIER_FL_NUM=str(n)) for n in range(1, 40)]), clean_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        keyed, rows = dense_keys(spark.read.parquet(clean_path), files.ROW_ID, "flight_key")
        plan = keyed._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
        found = keyed.orderBy("flight_key").select("flight_key", "flight_number").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == 39 and [tuple(r) for r in found] == [(n, n) for n in range(1, 40)]



def test_mismatch_keeps_only_the_columns_that_are_compared(spark):
    from flightlake.catalog import QUERIES, Workspace

    fresh = "/root/testdata/sf0.001/././."  # a name that no other test has opened
    found = QUERIES["dq_warehouse_mismatch"](spark, fresh)
    ws = Workspace.of(spark, fresh)
    assert "edge_clean" not in vars(ws)
    whole = checks.validate_warehouse(ws.edge_clean, ws.star)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))
