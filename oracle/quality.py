"""SQL for the profile, the suites and the warehouse checks."""

from __future__ import annotations

from flightlake import contracts as K
from oracle.base import (
    CLEAN,
    COMPACT,
    EDGE,
    EDGE_CLEAN,
    FLIGHT_DATE,
    STAR,
    CLEAN_CTES,
    big,
    hour,
    number,
    r,
)

SQL: dict[str, str] = {}


def rule_rows(prefix: str, source: str, rules: list[tuple[str, str, str]], more: str = "") -> str:
    """rules: (name, severity, aggregate expression over `source`)."""
    picks = ",\n  ".join(f"{expr} AS {name}" for name, _, expr in rules)
    rows = "\nUNION ALL ".join(
        f"SELECT '{name}' AS rule_name, '{severity}' AS severity, "
        f"CASE WHEN {name} = 0 THEN 'PASS' WHEN '{severity}' = 'warning' THEN 'WARNING' ELSE 'FAIL' END "
        f"AS status, CAST({name} AS BIGINT) AS failed_row_count FROM onerow"
        for name, severity, _ in rules
    )
    return f"{prefix}{more},\nonerow AS MATERIALIZED (SELECT {picks} FROM {source})\n{rows}"


def bad(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


# ---- profile

_missing = sorted(set(K.RAW_COLUMNS) - set(K.COMPACT_COLUMNS))
_unexpected = sorted(set(K.COMPACT_COLUMNS) - set(K.RAW_COLUMNS))
SQL["profile_schema_diff"] = f"""{COMPACT}
SELECT column_name, finding, (SELECT count(*) FROM raw) AS affected_rows FROM (VALUES
{', '.join([f"('{c}', 'missing')" for c in _missing] + [f"('{c}', 'unexpected')" for c in _unexpected])}
) t(column_name, finding)"""
_n = ", ".join(f"count({c}) AS {c}" for c in K.RAW_COLUMNS)
SQL["profile_missing"] = (
    f"{EDGE},\nonerow AS MATERIALIZED (SELECT count(*) AS n, {_n} FROM raw)\n"
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, n - {c} AS missing_count, "
        f"{r(f'100.0 * (n - {c}) / n')} AS missing_percentage FROM onerow"
        for c in K.RAW_COLUMNS
    )
)
_t = ", ".join(
    f"count({number(c)}) AS num_{c}, count({c}) AS has_{c}, "
    f"count(*) FILTER ({number(c)} = floor({number(c)}) AND {c} NOT LIKE '%.%') AS whole_{c}"
    for c in K.RAW_COLUMNS
)
SQL["profile_types"] = (
    f"{EDGE},\nonerow AS MATERIALIZED (SELECT count(*) AS n, {_t} FROM raw)\n"
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, CASE WHEN num_{c} < has_{c} THEN 'object' "
        f"WHEN whole_{c} = n THEN 'int64' ELSE 'float64' END AS data_type FROM onerow"
        for c in K.RAW_COLUMNS
    )
)
SQL["profile_coverage"] = f"""{EDGE}
SELECT min({FLIGHT_DATE}) AS first_date, max({FLIGHT_DATE}) AS last_date,
  count(*) FILTER (({FLIGHT_DATE}) IS NULL) AS invalid_dates
FROM raw"""
_DUPES = f"""
exact AS (SELECT count(*) AS n FROM raw GROUP BY {', '.join(K.RAW_COLUMNS)}),
keyed AS (SELECT count(*) AS n FROM raw GROUP BY {', '.join(K.RAW_KEY)})"""
SQL["profile_duplicates"] = f"""{EDGE},{_DUPES}
SELECT (SELECT CAST(sum(n - 1) AS BIGINT) FROM exact) AS exact_duplicates,
  (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM keyed WHERE n > 1) AS duplicate_key_rows"""
SQL["profile_flights"] = f"""{EDGE}
SELECT count(DISTINCT OP_CARRIER_AIRLINE_ID) AS unique_airlines,
  count(DISTINCT ORIGIN_AIRPORT_ID) AS unique_origins,
  count(DISTINCT DEST_AIRPORT_ID) AS unique_destinations,
  {bad(number('CANCELLED') + ' = 1')} AS cancelled_flights,
  {bad(number('DIVERTED') + ' = 1')} AS diverted_flights,
  {bad(number('ARR_DEL15') + ' = 1')} AS late_flights
FROM raw"""

# ---- raw suite

_numeric = [
    "YEAR", "QUARTER", "MONTH", "DAY_OF_MONTH", "DAY_OF_WEEK", "CANCELLED", "DIVERTED",
    "DEP_DEL15", "ARR_DEL15", *K.RAW_NON_NEGATIVE,
]
_read = ", ".join(f"{number(c)} AS n_{c}" for c in _numeric)
_raw_more = f",{_DUPES},\nread AS (SELECT {FLIGHT_DATE} AS day, {_read}, * FROM raw)"


def _off(part: str, column: str) -> str:
    return bad(f"day IS NOT NULL AND n_{column} IS DISTINCT FROM {part}(day)")


_raw_rules = [
    ("required_columns_present", "critical", "0"),
    ("valid_flight_dates", "critical", bad("day IS NULL")),
    ("year_matches_flight_date", "critical", _off("year", "YEAR")),
    ("quarter_matches_flight_date", "critical", _off("quarter", "QUARTER")),
    ("month_matches_flight_date", "critical", _off("month", "MONTH")),
    ("day_matches_flight_date", "critical", _off("day", "DAY_OF_MONTH")),
    ("weekday_matches_flight_date", "critical", _off("isodow", "DAY_OF_WEEK")),
    ("selected_period", "critical", bad("n_YEAR IS DISTINCT FROM 1998 OR n_MONTH IS DISTINCT FROM 6")),
    ("flight_key_not_missing", "critical", bad(" OR ".join(f"{c} IS NULL" for c in K.RAW_KEY))),
    ("no_exact_duplicate_rows", "critical", "(SELECT sum(n - 1) FROM exact)"),
    ("unique_flight_keys", "critical", "(SELECT coalesce(sum(n), 0) FROM keyed WHERE n > 1)"),
    ("valid_cancelled_indicator", "critical", bad("n_CANCELLED IS NULL OR n_CANCELLED NOT IN (0, 1)")),
    ("valid_diverted_indicator", "critical", bad("n_DIVERTED IS NULL OR n_DIVERTED NOT IN (0, 1)")),
    ("flight_not_cancelled_and_diverted", "critical", bad("n_CANCELLED = 1 AND n_DIVERTED = 1")),
    *[
        (f"{c.lower()}_not_missing", "critical", bad(f"{c} IS NULL"))
        for c in ("OP_UNIQUE_CARRIER", "ORIGIN", "DEST", "CRS_DEP_TIME", "CRS_ARR_TIME", "FLIGHTS", "DISTANCE")
    ],
    ("non_negative_measurements", "critical", bad(" OR ".join(f"n_{c} < 0" for c in K.RAW_NON_NEGATIVE))),
    (
        "departure_delay_indicator_consistent",
        "critical",
        bad("CASE WHEN n_DEP_DELAY_NEW >= 15 THEN 1 WHEN n_DEP_DELAY_NEW < 15 THEN 0 END <> n_DEP_DEL15"),
    ),
    (
        "arrival_delay_indicator_consistent",
        "critical",
        bad("CASE WHEN n_ARR_DELAY_NEW >= 15 THEN 1 WHEN n_ARR_DELAY_NEW < 15 THEN 0 END <> n_ARR_DEL15"),
    ),
    ("cancelled_flights_have_reason", "warning", bad("n_CANCELLED = 1 AND CANCELLATION_CODE IS NULL")),
    ("active_flights_have_no_cancellation_code", "warning", bad("n_CANCELLED = 0 AND CANCELLATION_CODE IS NOT NULL")),
    ("origin_differs_from_destination", "warning", bad("ORIGIN_AIRPORT_ID = DEST_AIRPORT_ID")),
]
SQL["dq_raw"] = rule_rows(EDGE, "read", _raw_rules, _raw_more)
SQL["dq_overall"] = f"""WITH results AS (
{SQL['dq_raw']}
)
SELECT count(*) AS rules_checked,
  count(*) FILTER (severity = 'critical' AND status = 'FAIL') AS critical_failures,
  count(*) FILTER (status = 'WARNING') AS warnings,
  CASE WHEN count(*) FILTER (severity = 'critical' AND status = 'FAIL') > 0 THEN 'FAIL'
    WHEN count(*) FILTER (status = 'WARNING') > 0 THEN 'PASS WITH WARNINGS' ELSE 'PASS' END
    AS overall_status
FROM results"""

# ---- clean suite

_no_key = " OR ".join(f"{c} IS NULL" for c in K.CLEAN_KEY)
_no_required = " OR ".join(f"{c} IS NULL" for c in K.WAREHOUSE_REQUIRED)
_negative = " OR ".join(f"{c} < 0" for c in K.CLEAN_NON_NEGATIVE)
_sum = " + ".join(K.CAUSE_COLUMNS)
_expected_status = "CASE WHEN cancelled = 1 THEN 'Cancelled' WHEN diverted = 1 THEN 'Diverted' ELSE 'Completed' END"


def _clean_rules(source: str) -> list[tuple[str, str, str]]:
    keyed = f"(SELECT count(*) AS n FROM {source} GROUP BY {', '.join(K.CLEAN_KEY)})"
    return [
        (name, "critical", expr)
        for name, expr in [
            ("required_columns_present", "0"),
            ("dataset_is_not_empty", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END"),
            ("flight_key_not_missing", bad(_no_key)),
            ("flight_key_is_unique", f"(SELECT coalesce(sum(n), 0) FROM {keyed} WHERE n > 1)"),
            ("warehouse_required_values_not_missing", bad(_no_required)),
            (
                "date_period",
                bad("year(flight_date) IS DISTINCT FROM 1998 OR month(flight_date) IS DISTINCT FROM 6"),
            ),
            (
                "calendar_fields_match_flight_date",
                bad(
                    "year <> year(flight_date) OR quarter <> quarter(flight_date) "
                    "OR month <> month(flight_date) OR day_of_month <> day(flight_date) "
                    "OR day_of_week <> isodow(flight_date)"
                ),
            ),
            (
                "flight_status_is_valid",
                bad("flight_status IS NULL OR flight_status NOT IN ('Completed', 'Cancelled', 'Diverted')"),
            ),
            ("flight_not_cancelled_and_diverted", bad("cancelled = 1 AND diverted = 1")),
            ("flight_status_matches_indicators", bad(f"flight_status <> {_expected_status}")),
            (
                "route_code_is_consistent",
                bad("route_code <> origin_airport_code || '-' || destination_airport_code"),
            ),
            ("weekend_indicator_is_consistent", bad("is_weekend <> (isodow(flight_date) IN (6, 7))")),
            (
                "scheduled_departure_hour_is_valid",
                bad(f"coalesce(scheduled_departure_hour <> ({hour('scheduled_departure_time')}), true)"),
            ),
            (
                "scheduled_arrival_hour_is_valid",
                bad(f"coalesce(scheduled_arrival_hour <> ({hour('scheduled_arrival_time')}), true)"),
            ),
            ("measurements_are_non_negative", bad(_negative)),
            ("total_reported_delay_is_consistent", bad(f"abs(total_reported_delay_minutes - ({_sum})) > 0.01")),
            (
                "arrival_on_time_is_consistent",
                bad(
                    "arrival_on_time IS DISTINCT FROM CASE WHEN flight_status = 'Completed' "
                    "AND arrival_delayed_15 IS NOT NULL THEN arrival_delayed_15 = 0 END"
                ),
            ),
        ]
    ]


SQL["dq_clean"] = rule_rows(EDGE_CLEAN, "clean", _clean_rules("clean"))
_corrupt = f""",
corrupted AS MATERIALIZED (
  SELECT * REPLACE (
    CASE WHEN scheduled_departure_hour = 1 THEN '?' ELSE route_code END AS route_code,
    CASE WHEN scheduled_departure_hour = 2 THEN NOT is_weekend ELSE is_weekend END AS is_weekend,
    CASE WHEN scheduled_departure_hour = 3 AND flight_status = 'Diverted' THEN 'Lost'
      ELSE flight_status END AS flight_status,
    CASE WHEN scheduled_departure_hour = 4 THEN NULL ELSE arrival_on_time END AS arrival_on_time,
    CASE WHEN scheduled_departure_hour = 5 THEN year + 1 ELSE year END AS year,
    CASE WHEN scheduled_departure_hour = 6 THEN NULL ELSE month END AS month,
    CASE WHEN scheduled_departure_hour = 7 THEN NULL ELSE scheduled_arrival_hour END
      AS scheduled_arrival_hour,
    CASE WHEN scheduled_departure_hour = 8 THEN total_reported_delay_minutes + 1
      ELSE total_reported_delay_minutes END AS total_reported_delay_minutes
  ) FROM clean
)"""
SQL["dq_clean_corrupted"] = rule_rows(CLEAN, "corrupted", _clean_rules("corrupted"), _corrupt)

# ---- warehouse suite


def _warehouse(prefix: str, source: str) -> str:
    flows = {
        "fact_flight_count": "count(*)",
        "completed_flight_count": "count(*) FILTER (flight_status = 'Completed')",
        "cancelled_flight_count": "count(*) FILTER (flight_status = 'Cancelled')",
        "diverted_flight_count": "count(*) FILTER (flight_status = 'Diverted')",
        "on_time_arrival_count": "count(*) FILTER (arrival_on_time)",
        "delayed_arrival_count": "count(*) FILTER (NOT arrival_on_time)",
        "unknown_arrival_count": "count(*) FILTER (arrival_on_time IS NULL)",
        "reported_delay_minutes_reconcile": big("sum(total_reported_delay_minutes)"),
    }
    expected = {
        "date_dimension_count": "count(DISTINCT flight_date)",
        "airline_dimension_count": "count(DISTINCT reporting_airline_id)",
        "airport_dimension_count": (
            f"(SELECT count(DISTINCT i) FROM (SELECT origin_airport_id AS i FROM {source} "
            f"UNION ALL SELECT destination_airport_id FROM {source}))"
        ),
        **flows,
    }
    actual = {
        "date_dimension_count": "(SELECT count(*) FROM dim_date)",
        "airline_dimension_count": "(SELECT count(*) FROM dim_airline)",
        "airport_dimension_count": "(SELECT count(*) FROM dim_airport)",
        **flows,
    }
    e = ", ".join(f"{v} AS {k}" for k, v in expected.items())
    a = ", ".join(f"{v} AS {k}" for k, v in actual.items())
    repeated = (
        f"(SELECT count(*) FROM (SELECT 1 FROM fact GROUP BY {', '.join(K.FACT_NATURAL_KEY)} "
        "HAVING count(*) > 1))"
    )
    orphans = ["no_orphan_date_keys", "no_orphan_airline_keys", "no_orphan_origin_keys", "no_orphan_destination_keys"]
    pairs = [
        f"SELECT '{k}' AS rule_name, CAST((SELECT {k} FROM exp) AS DOUBLE) AS expected_value, "
        f"CAST((SELECT {k} FROM act) AS DOUBLE) AS actual_value"
        for k in expected
    ]
    pairs += [f"SELECT '{k}', 0.0, 0.0" for k in orphans]
    pairs += [f"SELECT 'fact_natural_key_is_unique', 0.0, CAST({repeated} AS DOUBLE)"]
    rows = "\nUNION ALL ".join(pairs)
    return f"""{prefix},
exp AS MATERIALIZED (SELECT {e} FROM {source}),
act AS MATERIALIZED (SELECT {a} FROM fact),
pairs AS ({rows})
SELECT rule_name,
  CASE WHEN expected_value = actual_value THEN 'PASS'
    WHEN rule_name = 'reported_delay_minutes_reconcile' AND abs(expected_value - actual_value) <= 0.01
    THEN 'PASS' ELSE 'FAIL' END AS status,
  CAST(expected_value AS DOUBLE) AS expected_value, CAST(actual_value AS DOUBLE) AS actual_value
FROM pairs"""


SQL["dq_warehouse"] = _warehouse(STAR, "clean")


def _renamed_edge() -> str:
    """Star of the sound rows plus the faulted clean rows as `edge_clean`."""
    edge = EDGE[len("WITH ") :]
    own = edge[edge.index("\ntyped_text AS") :].replace("\nraw AS MATERIALIZED (", "\nedge_raw AS MATERIALIZED (")
    cleaned = (
        CLEAN_CTES.replace("typed AS MATERIALIZED", "edge_typed AS MATERIALIZED")
        .replace(" FROM raw)", " FROM edge_raw)")
        .replace("uniq AS (SELECT DISTINCT * FROM typed)", "edge_uniq AS (SELECT DISTINCT * FROM edge_typed)")
        .replace("clean AS MATERIALIZED", "edge_clean AS MATERIALIZED")
        .replace("FROM uniq", "FROM edge_uniq")
    )
    return f"{STAR},{own},\n{cleaned}"


_BOTH = _renamed_edge()
SQL["dq_warehouse_mismatch"] = _warehouse(_BOTH, "edge_clean")
SQL["dq_orphans"] = f"""{STAR},
kept_airline AS (SELECT * FROM dim_airline WHERE airline_key < (SELECT max(airline_key) FROM dim_airline)),
kept_airport AS (SELECT * FROM dim_airport WHERE airport_key < (SELECT max(airport_key) FROM dim_airport))
SELECT 'no_orphan_date_keys' AS rule_name, count(*) AS orphan_rows
FROM fact f LEFT JOIN dim_date d ON f.date_key = d.date_key WHERE d.date_key IS NULL
UNION ALL
SELECT 'no_orphan_airline_keys', count(*)
FROM fact f LEFT JOIN kept_airline d ON f.airline_key = d.airline_key WHERE d.airline_key IS NULL
UNION ALL
SELECT 'no_orphan_origin_keys', count(*)
FROM fact f LEFT JOIN kept_airport d ON f.origin_airport_key = d.airport_key WHERE d.airport_key IS NULL
UNION ALL
SELECT 'no_orphan_destination_keys', count(*)
FROM fact f LEFT JOIN kept_airport d ON f.destination_airport_key = d.airport_key
WHERE d.airport_key IS NULL"""

# ---- table constraints

_required_fact = [
    *K.FACT_NATURAL_KEY, "route_code", "scheduled_arrival_time", "flight_count", "distance_miles",
    "cancelled", "diverted", "flight_status", "delay_cause_reported", *K.CAUSE_COLUMNS,
    "total_reported_delay_minutes",
]
_row_constraints = [
    (name, "critical", bad(cond))
    for name, cond in [
        ("required_values_present", " OR ".join(f"{c} IS NULL" for c in _required_fact)),
        ("departure_hour_in_range", "coalesce(scheduled_departure_hour NOT BETWEEN 0 AND 23, true)"),
        ("arrival_hour_in_range", "coalesce(scheduled_arrival_hour NOT BETWEEN 0 AND 23, true)"),
        ("measures_non_negative", _negative),
        ("flight_count_positive", "flight_count <= 0"),
        ("route_code_not_blank", "trim(route_code) = ''"),
        ("status_in_domain", "flight_status NOT IN ('Completed', 'Cancelled', 'Diverted')"),
        (
            "status_agrees_with_flags",
            "NOT coalesce((flight_status = 'Completed' AND NOT cancelled AND NOT diverted) "
            "OR (flight_status = 'Cancelled' AND cancelled AND NOT diverted) "
            "OR (flight_status = 'Diverted' AND NOT cancelled AND diverted), false)",
        ),
        ("delay_total_agrees", f"abs(total_reported_delay_minutes - ({_sum})) > 0.05"),
    ]
]
SQL["dq_constraints"] = rule_rows(
    STAR,
    "fact",
    [
        *_row_constraints,
        (
            "natural_key_unique",
            "critical",
            f"(SELECT count(*) FROM (SELECT 1 FROM fact GROUP BY {', '.join(K.FACT_NATURAL_KEY)} "
            "HAVING count(*) > 1))",
        ),
        (
            "airline_code_not_blank",
            "critical",
            "(SELECT count(*) FROM dim_airline WHERE trim(reporting_airline_code) = '')",
        ),
        (
            "airport_code_not_blank",
            "critical",
            "(SELECT count(*) FROM dim_airport WHERE trim(airport_code) = '')",
        ),
        (
            "calendar_in_range",
            "critical",
            "(SELECT count(*) FROM dim_date WHERE quarter_number NOT BETWEEN 1 AND 4 "
            "OR month_number NOT BETWEEN 1 AND 12 OR day_of_month NOT BETWEEN 1 AND 31 "
            "OR day_of_week_number NOT BETWEEN 1 AND 7)",
        ),
        (
            "foreign_keys_resolve",
            "critical",
            bad(
                "date_key NOT IN (SELECT date_key FROM dim_date) "
                "OR airline_key NOT IN (SELECT airline_key FROM dim_airline) "
                "OR origin_airport_key NOT IN (SELECT airport_key FROM dim_airport) "
                "OR destination_airport_key NOT IN (SELECT airport_key FROM dim_airport)"
            ),
        ),
    ],
)
_edge_booleans = ", ".join(f"CAST({c} AS BOOLEAN) AS {c}" for c in K.FACT_BOOLEANS)
SQL["dq_constraints_edge"] = rule_rows(
    _BOTH,
    "edge_fact",
    _row_constraints,
    f""",
edge_fact AS MATERIALIZED (
  SELECT c.* REPLACE ({_edge_booleans}), CAST(strftime(c.flight_date, '%Y%m%d') AS INTEGER) AS date_key,
    l.airline_key, o.airport_key AS origin_airport_key, t.airport_key AS destination_airport_key
  FROM edge_clean c
  LEFT JOIN dim_airline l ON c.reporting_airline_id = l.reporting_airline_id
  LEFT JOIN dim_airport o ON c.origin_airport_id = o.airport_id
  LEFT JOIN dim_airport t ON c.destination_airport_id = t.airport_id
)""",
)
SQL["dq_csv_roundtrip"] = SQL["dq_raw"]
