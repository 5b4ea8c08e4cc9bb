"""SQL for sources, both cleaners and their parts."""

from __future__ import annotations

from flightlake import contracts as K
from oracle.base import (
    CLEAN,
    CLEAN_COLUMNS,
    COMPACT,
    EDGE,
    EDGE_CLEAN,
    FLIGHT_DATE,
    RAW,
    STATUS,
    TYPED,
    hour,
    long,
    measure,
    number,
    r,
    text,
    whole,
)

SQL: dict[str, str] = {}

SQL["src_csv_roundtrip"] = (
    f"{RAW}\nSELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in K.RAW_COLUMNS) + " FROM raw"
)
SQL["src_pruned_scan"] = (
    f"{CLEAN}\nSELECT "
    + ", ".join(c for c in K.DASHBOARD_COLUMNS if c != "reporting_airline_name")
    + " FROM clean"
)
SQL["sink_parquet_roundtrip"] = f"{CLEAN}\nSELECT {CLEAN_COLUMNS} FROM clean"
SQL["clean_bts"] = f"{CLEAN}\nSELECT {CLEAN_COLUMNS} FROM clean"
SQL["clean_edge"] = f"{EDGE_CLEAN}\nSELECT {CLEAN_COLUMNS} FROM clean"

# ---- compact layout

_carriers = ", ".join(f"('{c}', '{n}', {i})" for c, n, i in K.CARRIERS)
_airports = ", ".join(
    "(" + ", ".join(f"'{v}'" for v in row[:4]) + f", {row[4]})" for row in K.AIRPORTS
)
_LOOKUPS = f"""
carriers(code, name, id) AS (VALUES {_carriers}),
airports(code, city, st, state, id) AS (VALUES {_airports})"""


def _fallback(code: str) -> str:
    return f"CAST(10000 + CAST('0x' || substr(md5({code}), 1, 8) AS BIGINT) % 90000 AS INTEGER)"


def _airport_columns(side: str, alias: str, code: str) -> str:
    return (
        f"coalesce({alias}.id, {_fallback(code)}) AS {side}_airport_id, "
        f"coalesce({alias}.city, {code} || ', US') AS {side}_city_name, "
        f"coalesce({alias}.st, 'US') AS {side}_state_code, "
        f"coalesce({alias}.state, 'United States') AS {side}_state_name"
    )


_causes = {
    "carrier_delay_minutes": "AIRLINE_DELAY",
    "weather_delay_minutes": "WEATHER_DELAY",
    "national_air_system_delay_minutes": "AIR_SYSTEM_DELAY",
    "security_delay_minutes": "SECURITY_DELAY",
    "late_aircraft_delay_minutes": "LATE_AIRCRAFT_DELAY",
}
_total = " + ".join(f"coalesce({measure(c)}, 0)" for c in _causes.values())


def _delay(side: str) -> str:
    v = measure(f"{side.upper()}_DELAY")
    return (
        f"{v} AS {side}_delay_minutes_signed, "
        f"CASE WHEN {v} < 0 THEN 0.0 ELSE {v} END AS {side}_delay_minutes, "
        f"CASE WHEN {v} >= 15 THEN 1 WHEN {v} < 15 THEN 0 END AS {side}_delayed_15"
    )


def _scheduled(side: str) -> str:
    return f"coalesce({whole('SCHEDULED_' + side.upper(), 'int16')}, 0)"


def _block(side: str) -> str:
    h = f"lpad(CAST({hour('scheduled_' + side + '_time')} AS VARCHAR), 2, '0')"
    return f"{h} || '00-' || {h} || '59' AS {side}_time_block"


def _compact_clean(where: str = "") -> str:
    return f"""{COMPACT},{_LOOKUPS},
parts AS (
  SELECT make_date({whole('YEAR')}, {whole('MONTH')}, {whole('DAY')}) AS flight_date,
    {text('AIRLINE')} AS reporting_airline_code,
    coalesce({whole('FLIGHT_NUMBER', 'int64')}, 0) AS flight_number,
    {text('TAIL_NUMBER')} AS tail_number,
    {text('ORIGIN_AIRPORT')} AS origin_airport_code,
    {text('DESTINATION_AIRPORT')} AS destination_airport_code,
    {_scheduled('departure')} AS scheduled_departure_time,
    {whole('DEPARTURE_TIME', 'int16')} AS actual_departure_time,
    {_scheduled('arrival')} AS scheduled_arrival_time,
    {whole('ARRIVAL_TIME', 'int16')} AS actual_arrival_time,
    {_delay('departure')}, {_delay('arrival')},
    coalesce({whole('CANCELLED', 'int8')}, 0) AS cancelled,
    {text('CANCELLATION_REASON')} AS cancellation_code,
    coalesce({whole('DIVERTED', 'int8')}, 0) AS diverted,
    {', '.join(f'coalesce({measure(src)}, 0) AS {name}' for name, src in _causes.items())},
    CAST({_total} AS DOUBLE) AS total_reported_delay_minutes,
    ({_total}) > 0 AS delay_cause_reported,
    {measure('TAXI_OUT')} AS taxi_out_minutes, {measure('TAXI_IN')} AS taxi_in_minutes,
    {measure('SCHEDULED_TIME')} AS scheduled_elapsed_minutes,
    {measure('ELAPSED_TIME')} AS actual_elapsed_minutes, {measure('AIR_TIME')} AS air_time_minutes,
    coalesce({measure('DISTANCE')}, 0) AS distance_miles
  FROM (SELECT DISTINCT * FROM raw {where}) u
),
compact_clean AS MATERIALIZED (
  SELECT p.*,
    coalesce(k.name, p.reporting_airline_code) AS reporting_airline_name,
    coalesce(k.id, {_fallback('p.reporting_airline_code')}) AS reporting_airline_id,
    {_airport_columns('origin', 'o', 'p.origin_airport_code')},
    {_airport_columns('destination', 't', 'p.destination_airport_code')},
    CAST(year(flight_date) AS INTEGER) AS year, CAST(quarter(flight_date) AS INTEGER) AS quarter,
    CAST(month(flight_date) AS INTEGER) AS month, CAST(day(flight_date) AS INTEGER) AS day_of_month,
    CAST(isodow(flight_date) AS INTEGER) AS day_of_week, isodow(flight_date) >= 6 AS is_weekend,
    {hour('scheduled_departure_time')} AS scheduled_departure_hour,
    {hour('scheduled_arrival_time')} AS scheduled_arrival_hour,
    {_block('departure')}, {_block('arrival')},
    {STATUS} AS flight_status,
    CASE WHEN ({STATUS}) = 'Completed' AND arrival_delayed_15 IS NOT NULL
      THEN arrival_delayed_15 = 0 END AS arrival_on_time,
    CAST(least(floor(distance_miles / 250) + 1, 11) AS INTEGER) AS distance_group,
    1 AS flight_count,
    p.origin_airport_code || '-' || p.destination_airport_code AS route_code
  FROM parts p
  LEFT JOIN carriers k ON p.reporting_airline_code = k.code
  LEFT JOIN airports o ON p.origin_airport_code = o.code
  LEFT JOIN airports t ON p.destination_airport_code = t.code
)"""


_FULL = _compact_clean()
_compact_columns = """
year, quarter, month, day_of_month, day_of_week, flight_date, reporting_airline_code,
reporting_airline_name, reporting_airline_id, tail_number, flight_number, origin_airport_id,
origin_airport_code, origin_city_name, origin_state_code, origin_state_name,
destination_airport_id, destination_airport_code, destination_city_name, destination_state_code,
destination_state_name, scheduled_departure_time, actual_departure_time,
departure_delay_minutes_signed, departure_delay_minutes, departure_delayed_15,
departure_time_block, taxi_out_minutes, taxi_in_minutes, scheduled_arrival_time,
actual_arrival_time, arrival_delay_minutes_signed, arrival_delay_minutes, arrival_delayed_15,
arrival_time_block, cancelled, cancellation_code, diverted, scheduled_elapsed_minutes,
actual_elapsed_minutes, air_time_minutes, flight_count, distance_miles, distance_group,
carrier_delay_minutes, weather_delay_minutes, national_air_system_delay_minutes,
security_delay_minutes, late_aircraft_delay_minutes, delay_cause_reported,
total_reported_delay_minutes, route_code, is_weekend, scheduled_departure_hour,
scheduled_arrival_hour, flight_status, arrival_on_time"""
SQL["clean_compact"] = f"{_FULL}\nSELECT {_compact_columns} FROM compact_clean"
SQL["clean_compact_month"] = f"""{_compact_clean('WHERE MONTH = 1')}
SELECT year, month, flight_status, count(*) AS flights,
  CAST(sum(total_reported_delay_minutes) AS DOUBLE) AS delay_minutes
FROM compact_clean GROUP BY ALL"""
SQL["lookup_airline"] = f"""{COMPACT},{_LOOKUPS},
used AS (SELECT {text('AIRLINE')} AS reporting_airline_code, count(*) AS flights FROM raw GROUP BY 1)
SELECT reporting_airline_code, flights, coalesce(k.name, reporting_airline_code) AS reporting_airline_name,
  coalesce(k.id, {_fallback('reporting_airline_code')}) AS reporting_airline_id
FROM used LEFT JOIN carriers k ON reporting_airline_code = k.code"""
SQL["lookup_airport"] = f"""{COMPACT},{_LOOKUPS},
used AS (SELECT {text('ORIGIN_AIRPORT')} AS origin_airport_code, count(*) AS flights FROM raw GROUP BY 1)
SELECT origin_airport_code, flights, {_airport_columns('origin', 'a', 'origin_airport_code')}
FROM used LEFT JOIN airports a ON origin_airport_code = a.code"""
SQL["time_block"] = f"""{COMPACT},
hours AS (
  SELECT {hour('t')} AS hour FROM (
    SELECT coalesce({number('SCHEDULED_DEPARTURE')}, 0) AS t FROM raw
  )
)
SELECT hour, printf('%02d00-%02d59', hour, hour) AS time_block, count(*) AS flights
FROM hours GROUP BY hour"""
_delays = ", ".join(
    f"{side}_{part}"
    for side in ("departure", "arrival")
    for part in ("delay_minutes_signed", "delay_minutes", "delayed_15")
)
SQL["delay_derivation"] = f"{_FULL}\nSELECT flight_number, flight_date, {_delays} FROM compact_clean"
SQL["delay_causes_compact"] = f"""{_FULL}
SELECT flight_number, flight_date, {', '.join(K.CAUSE_COLUMNS)}, total_reported_delay_minutes,
  delay_cause_reported
FROM compact_clean"""
SQL["distance_group"] = f"""{_FULL}
SELECT distance_miles, distance_group, count(*) AS flights FROM compact_clean GROUP BY ALL"""
SQL["clean_dispatch"] = f"""{_FULL}
SELECT 'compact' AS layout, flight_status, count(*) AS flights FROM compact_clean GROUP BY ALL
UNION ALL
SELECT 'standard', CASE WHEN canc THEN 'Cancelled' WHEN dv THEN 'Diverted' ELSE 'Completed' END,
  count(*)
FROM derived GROUP BY ALL"""

# ---- parts of the standard cleaner

SQL["clean_summary"] = long(
    EDGE_CLEAN,
    "clean",
    {
        "input_rows": "(SELECT count(*) FROM raw)",
        "input_columns": "48",
        "clean_columns": "56",
        "duplicates_removed": "(SELECT count(*) FROM raw) - count(*)",
        "clean_rows": "count(*)",
        "completed": "count(*) FILTER (flight_status = 'Completed')",
        "completed_pct": r("100.0 * count(*) FILTER (flight_status = 'Completed') / count(*)", 1),
        "cancelled": "count(*) FILTER (flight_status = 'Cancelled')",
        "cancelled_pct": r("100.0 * count(*) FILTER (flight_status = 'Cancelled') / count(*)", 1),
        "diverted": "count(*) FILTER (flight_status = 'Diverted')",
        "diverted_pct": r("100.0 * count(*) FILTER (flight_status = 'Diverted') / count(*)", 1),
        "on_time": "count(*) FILTER (arrival_on_time)",
        "on_time_pct": r("100.0 * count(*) FILTER (arrival_on_time) / count(*) FILTER (flight_status = 'Completed')"),
        "delayed": "count(*) FILTER (NOT arrival_on_time)",
        "delayed_pct": r("100.0 - 100.0 * count(*) FILTER (arrival_on_time) / count(*) FILTER (flight_status = 'Completed')"),
    },
    "metric",
    "value",
)
_lost = sorted(set(K.RAW_COLUMNS) - set(K.COMPACT_COLUMNS))
SQL["contract_missing_columns"] = f"""{COMPACT}
SELECT column_name, (SELECT count(*) FROM raw) AS affected_rows
FROM (VALUES {', '.join(f"('{c}')" for c in _lost)}) t(column_name)"""
SQL["parse_flight_date"] = f"""{EDGE}
SELECT FL_DATE, {FLIGHT_DATE} AS flight_date, count(*) AS flights FROM raw GROUP BY ALL"""
SQL["trim_blank_null"] = f"""{EDGE}
SELECT OP_CARRIER_FL_NUM, {text('TAIL_NUM')} AS tail_num,
  {text('CANCELLATION_CODE')} AS cancellation_code, {text('ORIGIN')} AS origin
FROM raw"""
SQL["safe_cast_int"] = f"{EDGE}\nSELECT OP_CARRIER_FL_NUM, " + ", ".join(
    f"{whole(c)} AS {c.lower()}"
    for c in ("MONTH", "ORIGIN_AIRPORT_ID", "CANCELLED", "FLIGHTS", "DEP_TIME")
) + " FROM raw"
SQL["safe_cast_float"] = f"{EDGE}\nSELECT OP_CARRIER_FL_NUM, " + ", ".join(
    f"{measure(c)} AS {c.lower()}" for c in ("TAXI_OUT", "DISTANCE", "ARR_DELAY", "CARRIER_DELAY")
) + " FROM raw"
SQL["hhmm_hour"] = f"{EDGE}\nSELECT OP_CARRIER_FL_NUM, " + ", ".join(
    f"{hour(number(c))} AS {c.lower()}_hour" for c in ("CRS_DEP_TIME", "CRS_ARR_TIME", "DEP_TIME", "ARR_TIME")
) + " FROM raw"

_ints = [c for c in K.RAW_LAYOUT if c.is_integer]
_misfit = " OR ".join(
    f"({number(c.raw)} IS NOT NULL AND ({whole(c.raw, c.kind)}) IS NULL)" for c in _ints
)
_null_columns = """flight_date reporting_airline_id reporting_airline_code flight_number
origin_airport_id origin_airport_code destination_airport_id destination_airport_code
scheduled_departure_time scheduled_arrival_time flight_count distance_miles cancelled
diverted""".split()
_no_key = " OR ".join(f"{c} IS NULL" for c in K.CLEAN_KEY)
SQL["gate_counts"] = f"""{EDGE},
{TYPED},
misfits AS (SELECT count(*) AS n FROM raw WHERE {_misfit})
SELECT count(*) AS total_rows,
  count(*) FILTER (flight_date IS NULL) AS invalid_flight_dates,
  (SELECT n FROM misfits) AS unsafe_integers,
  count(*) FILTER ({_no_key}) AS missing_flight_keys,
  count(*) FILTER (coalesce(cancelled NOT IN (0, 1), true) OR coalesce(diverted NOT IN (0, 1), true))
    AS invalid_status_flags,
  count(*) FILTER (cancelled = 1 AND diverted = 1) AS cancelled_and_diverted,
  count(*) FILTER (({hour('scheduled_departure_time')}) IS NULL) AS invalid_scheduled_departure_time,
  count(*) FILTER (({hour('scheduled_arrival_time')}) IS NULL) AS invalid_scheduled_arrival_time,
  {', '.join(f'count(*) FILTER ({c} IS NULL) AS null_{c}' for c in _null_columns)},
  count(*) FILTER (origin_airport_code || destination_airport_code IS NULL) AS null_route_code
FROM typed"""
SQL["dedup_exact"] = f"""{EDGE},
{TYPED}
SELECT a.month, a.n AS all_rows, u.n AS kept_rows, a.n - u.n AS removed
FROM (SELECT month, count(*) AS n FROM typed GROUP BY month) a
JOIN (SELECT month, count(*) AS n FROM (SELECT DISTINCT * FROM typed) GROUP BY month) u
  ON a.month IS NOT DISTINCT FROM u.month"""
SQL["delay_causes"] = f"""{CLEAN}
SELECT flight_number, flight_date, delay_cause_reported, {', '.join(K.CAUSE_COLUMNS)},
  total_reported_delay_minutes
FROM clean"""
SQL["calendar_fields"] = f"""{EDGE_CLEAN}
SELECT flight_date, year, quarter, month, day_of_month, day_of_week, is_weekend, count(*) AS flights
FROM clean GROUP BY ALL"""
SQL["flight_status"] = f"""{EDGE_CLEAN}
SELECT cancelled, diverted, flight_status, arrival_delayed_15, arrival_on_time, count(*) AS flights
FROM clean GROUP BY ALL"""
_counts = ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in K.WAREHOUSE_REQUIRED)
SQL["required_null_counts"] = f"""{EDGE_CLEAN},
onerow AS MATERIALIZED (SELECT {_counts} FROM clean)
""" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS missing_count FROM onerow" for c in K.WAREHOUSE_REQUIRED
)
_key_order = """flight_date, reporting_airline_id, flight_number, origin_airport_id,
scheduled_departure_time, destination_airport_id"""
SQL["canonical_topn"] = f"""{CLEAN}
SELECT {_key_order}, route_code, flight_status FROM clean ORDER BY {_key_order}"""
