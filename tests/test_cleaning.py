"""Cleaning rules on literal rows."""

from __future__ import annotations

import datetime as dt
import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flightlake.functions import casts, times
from flightlake.functions.metrics import rounded, share
from flightlake.operators.clean import clean_flights, clean_summary
from flightlake.operators.compact import clean_compact, fallback_id
from flightlake.operators.standard import clean_standard

CANCELLED = dict(CANCELLED="1", ARR_DEL15=None, DEP_DEL15=None)


def by_flight(df):
    return {r["flight_number"]: r for r in df.collect()}


def hours(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [
        r[0] for r in df.orderBy("i").select(times.hhmm_hour(casts.number(df, "t"))).collect()
    ]


def test_hhmm_accepts_valid_times_and_midnight(spark):
    assert hours(spark, ["5", "59", "100", "930", "2359", "2400", "930.0"]) == [0, 0, 1, 9, 23, 0, 9]


def test_hhmm_rejects_invalid_times(spark):
    values = ["2360", "2401", "2460", "2500", "-1", None, "bad", "9d", "NaN", ""]
    assert hours(spark, values) == [None] * len(values)


def test_texts_never_reach_the_cast_and_numbers_always_do(spark):
    texts = ["BOS", "Boston, MA", "0800-0859", "01/01/2024 12:00:00 AM", "N779JB", "", "12f", "3d ", "--1", "1-2"]
    assert not [t for t in texts if re.search(casts._NUMBER_LIKE, t)]
    numbers = ["5", " 5 ", "\t-5", "+.5", "5.", "1e-5", "-1E-5", "0x1p-3", "-Infinity", "1" * 5000 + ".0"]
    df = spark.createDataFrame([(t,) for t in texts + numbers], "t string")
    found = {r["t"]: r["n"] for r in df.select("t", casts.number(df, "t").alias("n")).collect()}
    assert all(found[t] is None for t in texts)
    assert [found[t] for t in numbers] == [5, 5, -5, 0.5, 5, 1e-5, -1e-5, 0.125, -math.inf, math.inf]


@settings(max_examples=5, deadline=None)
@given(values=st.lists(st.integers(-200, 3000), min_size=50, max_size=200))
def test_hhmm_matches_plain_arithmetic(spark, values):
    def expected(t):
        ok = t == 2400 or (0 <= t // 100 <= 23 and 0 <= t % 100 <= 59)
        return t // 100 % 24 if ok else None

    assert hours(spark, [str(v) for v in values]) == [expected(v) for v in values]


def test_route_and_hours(raw):
    row = clean_flights(raw()).first()
    assert (row["route_code"], row["scheduled_departure_hour"], row["scheduled_arrival_hour"]) == (
        "BOS-SEA", 8, 11,
    )


def test_calendar_follows_the_date(raw):
    row = clean_flights(
        raw(dict(DAY_OF_WEEK="7", QUARTER="4", MONTH="12", DAY_OF_MONTH="31"))
    ).first()
    assert [row[c] for c in ("year", "quarter", "month", "day_of_month", "day_of_week")] == [2024, 1, 1, 1, 1]
    assert row["is_weekend"] is False


def test_unpadded_date_is_read(raw):
    row = clean_flights(raw(dict(FL_DATE="1/2/1999 12:00:00 AM"))).first()
    assert row["flight_date"] == dt.date(1999, 1, 2)


def test_status(raw):
    rows = by_flight(
        clean_flights(
            raw(
                dict(OP_CARRIER_FL_NUM="1"),
                dict(OP_CARRIER_FL_NUM="2", **CANCELLED),
                dict(OP_CARRIER_FL_NUM="3", DIVERTED="1", ARR_DEL15=None),
            )
        )
    )
    assert [rows[i]["flight_status"] for i in (1, 2, 3)] == ["Completed", "Cancelled", "Diverted"]


def test_on_time_is_known_for_completed_flights_only(raw):
    rows = by_flight(
        clean_flights(
            raw(
                dict(OP_CARRIER_FL_NUM="1", ARR_DEL15="0"),
                dict(OP_CARRIER_FL_NUM="2", ARR_DEL15="1"),
                dict(OP_CARRIER_FL_NUM="3", **CANCELLED),
                dict(OP_CARRIER_FL_NUM="4", ARR_DEL15=None),
            )
        )
    )
    assert [rows[i]["arrival_on_time"] for i in (1, 2, 3, 4)] == [True, False, None, None]


def test_causes_and_total(raw):
    rows = by_flight(
        clean_flights(
            raw(
                dict(OP_CARRIER_FL_NUM="1"),
                dict(OP_CARRIER_FL_NUM="2", CARRIER_DELAY="10", WEATHER_DELAY="0", NAS_DELAY="5"),
                dict(OP_CARRIER_FL_NUM="3", SECURITY_DELAY="0"),
            )
        )
    )
    assert [rows[i]["delay_cause_reported"] for i in (1, 2, 3)] == [False, True, True]
    assert [rows[i]["total_reported_delay_minutes"] for i in (1, 2, 3)] == [0.0, 15.0, 0.0]


def test_exact_duplicates_are_removed_and_counted(raw):
    one, two = dict(OP_CARRIER_FL_NUM="1"), dict(OP_CARRIER_FL_NUM="2", TAIL_NUM="N456AA")
    source = raw(one, one, two)
    clean = clean_flights(source)
    summary = {r["metric"]: r["value"] for r in clean_summary(source, clean).collect()}
    assert clean.count() == 2
    assert summary["duplicates_removed"] == 1
    assert summary["completed_pct"] == 100.0


@pytest.mark.parametrize(
    "fault, message",
    [
        (dict(FL_DATE="not-a-date"), "1 rows have no readable flight date"),
        (dict(ORIGIN_AIRPORT_ID=None), "lack a part of the flight key"),
        (dict(CRS_DEP_TIME="2460"), "scheduled departure that is no time"),
        (dict(CRS_ARR_TIME="2401"), "scheduled arrival that is no time"),
        (dict(ORIGIN=None), "the warehouse needs: origin_airport_code=1, route_code=1"),
        (dict(DISTANCE="abc"), "the warehouse needs: distance_miles=1"),
        (dict(CANCELLED="1", DIVERTED="1"), "cancelled and diverted at once"),
        (dict(CANCELLED="2"), "status flag other than 0 and 1"),
        (dict(DIVERTED=None), "status flag other than 0 and 1"),
        (dict(FLIGHTS="1.5"), "do not fit an integer column"),
        (dict(QUARTER="300"), "do not fit an integer column"),
    ],
)
def test_gates_reject(raw, fault, message):
    with pytest.raises(ValueError, match=message):
        clean_flights(raw(fault))


def test_missing_column_is_rejected(raw):
    with pytest.raises(ValueError, match=r"lacks these columns: \['TAIL_NUM'\]"):
        clean_flights(raw().drop("TAIL_NUM"))


def test_blank_text_becomes_null(raw):
    row = clean_flights(raw(dict(CANCELLATION_CODE="   ", TAIL_NUM=" N1 "))).first()
    assert row["cancellation_code"] is None
    assert row["tail_number"] == "N1"


def test_typed_source_cleans_like_text(raw):
    source = raw(dict(ARR_DELAY="20", ARR_DELAY_NEW="20", ARR_DEL15="1"))
    numbers = source.withColumns(
        {c: F.col(c).cast("int") for c in ("CRS_DEP_TIME", "CANCELLED", "ARR_DEL15", "OP_CARRIER_FL_NUM")}
    ).withColumn("ARR_DELAY", F.col("ARR_DELAY").cast("double"))
    assert clean_standard(numbers).collect() == clean_standard(source).collect()


COMPACT = dict(
    YEAR=2015, MONTH=1, DAY=3, AIRLINE=" AA ", FLIGHT_NUMBER="98", TAIL_NUMBER="N1 ",
    ORIGIN_AIRPORT="ATL", DESTINATION_AIRPORT="Q9", SCHEDULED_DEPARTURE="5", DEPARTURE_TIME="2354",
    DEPARTURE_DELAY="-11", TAXI_OUT="21", SCHEDULED_TIME="205", ELAPSED_TIME="194", AIR_TIME="169",
    DISTANCE="2750", TAXI_IN="4", SCHEDULED_ARRIVAL="x", ARRIVAL_TIME="408", ARRIVAL_DELAY="22",
    DIVERTED=0, CANCELLED=0, CANCELLATION_REASON=None, AIR_SYSTEM_DELAY="7", SECURITY_DELAY=None,
    AIRLINE_DELAY="15", LATE_AIRCRAFT_DELAY=None, WEATHER_DELAY=None,
)


def compact_rows(spark, *overrides):
    rows = [{**COMPACT, **o} for o in (overrides or ({},))]
    kinds = {c: "int" if isinstance(v, int) else "string" for c, v in COMPACT.items()}
    return spark.createDataFrame(
        [tuple(r.values()) for r in rows], ", ".join(f"{c} {k}" for c, k in kinds.items())
    )


def test_compact_layout(spark):
    row = clean_flights(compact_rows(spark)).first()
    assert row["flight_date"] == dt.date(2015, 1, 3)
    assert (row["reporting_airline_name"], row["reporting_airline_id"]) == ("American Airlines Inc.", 19805)
    assert (row["origin_airport_id"], row["origin_city_name"]) == (10397, "Atlanta, GA")
    assert row["destination_city_name"] == "Q9, US"
    assert 10000 <= row["destination_airport_id"] < 100000
    assert (row["scheduled_departure_hour"], row["departure_time_block"]) == (0, "0000-0059")
    assert (row["scheduled_arrival_time"], row["scheduled_arrival_hour"]) == (0, 0)
    assert (row["departure_delay_minutes_signed"], row["departure_delay_minutes"]) == (-11.0, 0.0)
    assert (row["departure_delayed_15"], row["arrival_delayed_15"]) == (0, 1)
    assert row["arrival_on_time"] is False
    assert (row["total_reported_delay_minutes"], row["delay_cause_reported"]) == (22.0, True)
    assert row["distance_group"] == 11
    assert row["is_weekend"] is True


def test_compact_nulls_month_and_duplicates(spark):
    source = compact_rows(
        spark, {}, {}, dict(MONTH=2, ARRIVAL_DELAY=None, CANCELLED=1, DIVERTED=1, AIRLINE=None)
    )
    assert clean_compact(source).count() == 2
    row = clean_compact(source, month=2).first()
    assert row["flight_status"] == "Cancelled"
    assert row["arrival_delay_minutes"] is None and row["arrival_delayed_15"] is None
    assert row["reporting_airline_code"] is None and row["reporting_airline_id"] is None


def test_fallback_id_is_stable(spark):
    ids = spark.range(1).select(fallback_id(F.lit("ZZ")), fallback_id(F.lit("ZZ"))).first()
    assert ids[0] == ids[1]


def test_rounding_and_safe_share(spark):
    row = spark.range(1).select(
        rounded(F.lit(1.005)), share(F.lit(1), F.lit(3)), share(F.lit(1), F.lit(0))
    ).first()
    assert list(row) == [1.01, 33.33, None]


def test_publishing_shuffles_digests_and_sorts_source_rows_once(spark, raw, tmp_path):
    """No whole row is shuffled to find repeats where none repeats; copies are still one row."""
    from flightlake.operators.clean import publish_clean
    from flightlake.operators.duplicates import distinct_rows
    from flightlake.operators.standard import clean_by_digest

    lone = raw(*[dict(OP_CARRIER_FL_NUM=str(n)) for n in range(1, 9)])
    plan = clean_by_digest(lone)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    copies = raw(*[dict(OP_CARRIER_FL_NUM=str(n % 5), TAIL_NUM=None if n % 2 else "N1") for n in range(40)])
    assert sorted(distinct_rows(copies).collect(), key=str) == sorted(copies.distinct().collect(), key=str)
    assert sorted(publish_clean(copies, str(tmp_path / "a")).select("flight_number", "tail_number").collect(), key=str) == sorted(
        clean_standard(copies).select("flight_number", "tail_number").collect(), key=str
    )


def test_shuffles_start_with_partitions_for_the_source(spark):
    from flightlake import session

    kept = spark.conf.get(session.INITIAL_PARTITIONS, None)
    try:
        spark.conf.unset(session.INITIAL_PARTITIONS)
        session.spread(spark, 1000)
        assert session.partitions(spark) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        session.spread(spark, 90 * session.PARTITION_INPUT)
        session.spread(spark, 10 * session.PARTITION_INPUT)
        assert session.partitions(spark) == 90
    finally:
        spark.conf.set(session.INITIAL_PARTITIONS, kept) if kept else spark.conf.unset(session.INITIAL_PARTITIONS)


def test_repeats_are_looked_for_by_one_digest(spark, raw, monkeypatch):
    """8 bytes a row are shuffled for it, and rows that share a digest by chance all stay."""
    from flightlake.operators import duplicates

    kept, write = [], duplicates.staged
    monkeypatch.setattr(duplicates, "staged", lambda df, name: kept.append(df.columns) or write(df, name))
    copies = raw(*[dict(OP_CARRIER_FL_NUM=str(n % 5)) for n in range(20)])
    assert duplicates.distinct_rows(copies).count() == 5
    monkeypatch.setattr(duplicates, "row_digest", lambda df: {"_digest1": F.lit(1), "_digest2": F.lit(2)})
    assert duplicates.distinct_rows(copies).count() == 5
    assert kept == [["_digest1"], ["_digest1"]]


def test_sink_needs_no_other_clean_table(spark):
    from flightlake.catalog import QUERIES, Workspace

    fresh = "/root/testdata/sf0.001/./."  # a name that no other test has opened
    found = QUERIES["sink_parquet_roundtrip"](spark, fresh)
    ws = Workspace.of(spark, fresh)
    assert "clean_path" not in vars(ws)
    assert sorted(found.collect(), key=str) == sorted(ws.clean.select(*found.columns).collect(), key=str)
