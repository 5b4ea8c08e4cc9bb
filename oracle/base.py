"""Shared SQL pieces: input rows, clean rows, star tables, rounding."""

from __future__ import annotations

from flightlake import contracts as K
from flightlake.sources import driver_tables as D


def _portable(ctes: str) -> str:
    for table in D.TABLES:
        ctes = ctes.replace("{" + table + "}", table)
    ctes = ctes.replace("[isodow]", "isodow(d)")
    return ctes.replace("\nraw AS (", "\nraw AS MATERIALIZED (")


RAW = "WITH " + _portable(D.standard_sql())
EDGE = "WITH " + _portable(D.edge_sql())
COMPACT = "WITH " + _portable(D.compact_sql())


def r(value: str, digits: int = 2) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(18,6)), {digits}) AS DOUBLE)"


def big(value: str, digits: int = 2) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(38,6)), {digits}) AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    return r(f"100.0 * CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0)")


def hour(t: str) -> str:
    return (
        f"CASE WHEN {t} = 2400 THEN 0 WHEN {t} BETWEEN 0 AND 2359 "
        f"AND {t} - 100 * floor({t} / 100) BETWEEN 0 AND 59 "
        f"THEN CAST(floor({t} / 100) AS INTEGER) END"
    )


def number(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE)"


def whole(c: str, kind: str = "int32") -> str:
    low, high = K.INTEGER_RANGES[kind]
    into = "BIGINT" if kind == "int64" else "INTEGER"
    v = number(c)
    return f"CASE WHEN {v} = floor({v}) AND {v} BETWEEN {low} AND {high} THEN CAST({v} AS {into}) END"


def measure(c: str) -> str:
    return f"CAST(TRY_CAST({c} AS FLOAT) AS DOUBLE)"


def text(c: str) -> str:
    return f"NULLIF(TRIM({c}), '')"


FLIGHT_DATE = "CAST(TRY_STRPTIME(FL_DATE, '%m/%d/%Y %I:%M:%S %p') AS DATE)"


def _typed() -> str:
    out = []
    for c in K.RAW_LAYOUT:
        if c.kind == "date":
            value = FLIGHT_DATE
        elif c.kind == "float":
            value = measure(c.raw)
        elif c.kind == "text":
            value = text(c.raw)
        else:
            value = whole(c.raw, c.kind)
        out.append(f"{value} AS {c.clean}")
    return "typed AS MATERIALIZED (SELECT " + ",\n  ".join(out) + " FROM raw)"


TYPED = _typed()

_CALENDAR = {
    "year": "CAST(year(flight_date) AS INTEGER)",
    "quarter": "CAST(quarter(flight_date) AS INTEGER)",
    "month": "CAST(month(flight_date) AS INTEGER)",
    "day_of_month": "CAST(day(flight_date) AS INTEGER)",
    "day_of_week": "CAST(isodow(flight_date) AS INTEGER)",
}
STATUS = "CASE WHEN cancelled = 1 THEN 'Cancelled' WHEN diverted = 1 THEN 'Diverted' ELSE 'Completed' END"
_base = ", ".join(
    f"{_CALENDAR[c]} AS {c}" if c in _CALENDAR else f"coalesce({c}, 0) AS {c}" if c in K.CAUSE_COLUMNS else c
    for c in K.CLEAN_BASE_COLUMNS
)
_any_cause = " OR ".join(f"{c} IS NOT NULL" for c in K.CAUSE_COLUMNS)
_total = " + ".join(f"coalesce({c}, 0)" for c in K.CAUSE_COLUMNS)
CLEAN_CTES = f"""{TYPED},
uniq AS (SELECT DISTINCT * FROM typed),
clean AS MATERIALIZED (
  SELECT {_base},
    ({_any_cause}) AS delay_cause_reported,
    CAST({_total} AS DOUBLE) AS total_reported_delay_minutes,
    origin_airport_code || '-' || destination_airport_code AS route_code,
    isodow(flight_date) >= 6 AS is_weekend,
    {hour('scheduled_departure_time')} AS scheduled_departure_hour,
    {hour('scheduled_arrival_time')} AS scheduled_arrival_hour,
    {STATUS} AS flight_status,
    CASE WHEN ({STATUS}) = 'Completed' AND arrival_delayed_15 IS NOT NULL
      THEN arrival_delayed_15 = 0 END AS arrival_on_time
  FROM uniq
)"""
CLEAN = f"{RAW},\n{CLEAN_CTES}"
EDGE_CLEAN = f"{EDGE},\n{CLEAN_CTES}"
CLEAN_COLUMNS = ", ".join(K.CLEAN_BASE_COLUMNS + K.CLEAN_DERIVED_COLUMNS)

_order = ", ".join(
    [*K.CANONICAL_ORDER, *[c for c in K.CLEAN_KEY if c not in K.CANONICAL_ORDER]]
)
_booleans = {c: f"CAST(c.{c} AS BOOLEAN)" for c in K.FACT_BOOLEANS}
_fact_measures = ", ".join(f"{_booleans.get(c, 'c.' + c)} AS {c}" for c in K.FACT_MEASURES)
DATE_KEY = "CAST(strftime(flight_date, '%Y%m%d') AS INTEGER)"
DIM_CTES = f"""
dim_date AS (
  SELECT DISTINCT {DATE_KEY} AS date_key, flight_date AS full_date,
    CAST(year(flight_date) AS INTEGER) AS year_number,
    CAST(quarter(flight_date) AS INTEGER) AS quarter_number,
    CAST(month(flight_date) AS INTEGER) AS month_number, monthname(flight_date) AS month_name,
    CAST(day(flight_date) AS INTEGER) AS day_of_month,
    CAST(isodow(flight_date) AS INTEGER) AS day_of_week_number, dayname(flight_date) AS day_name,
    isodow(flight_date) >= 6 AS is_weekend
  FROM clean
),
dim_airline AS (
  SELECT CAST(row_number() OVER (ORDER BY reporting_airline_id) AS INTEGER) AS airline_key, *
  FROM (SELECT DISTINCT reporting_airline_id, reporting_airline_code FROM clean)
),
airports AS (
  SELECT origin_airport_id AS airport_id, origin_airport_code AS airport_code,
    origin_city_name AS city_name, origin_state_code AS state_code, origin_state_name AS state_name
  FROM clean
  UNION
  SELECT destination_airport_id, destination_airport_code, destination_city_name,
    destination_state_code, destination_state_name
  FROM clean
),
dim_airport AS (
  SELECT CAST(row_number() OVER (ORDER BY airport_id) AS INTEGER) AS airport_key, * FROM airports
)"""
STAR_CTES = f"""{DIM_CTES},
fact AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY {', '.join('c.' + x.strip() for x in _order.split(','))}) AS flight_key,
    {DATE_KEY.replace('flight_date', 'c.flight_date')} AS date_key,
    l.airline_key, o.airport_key AS origin_airport_key, t.airport_key AS destination_airport_key,
    {_fact_measures}
  FROM clean c
  LEFT JOIN dim_airline l ON c.reporting_airline_id = l.reporting_airline_id
  LEFT JOIN dim_airport o ON c.origin_airport_id = o.airport_id
  LEFT JOIN dim_airport t ON c.destination_airport_id = t.airport_id
)"""
STAR = f"{CLEAN},{STAR_CTES}"

_airport = ["airport_id", "airport_code", "city_name", "state_code", "state_name"]
_detail = ", ".join(
    [
        "f.flight_key, f.date_key, d.full_date AS flight_date, d.year_number, d.quarter_number",
        "d.month_number, d.month_name, d.day_of_month, d.day_of_week_number, d.day_name",
        "d.is_weekend, f.airline_key, l.reporting_airline_id, l.reporting_airline_code",
        "f.origin_airport_key",
        *[f"o.{c} AS origin_{c}" for c in _airport],
        "f.destination_airport_key",
        *[f"t.{c} AS destination_{c}" for c in _airport],
        *[f"f.{c}" for c in K.FACT_MEASURES],
    ]
)
DETAIL = f"""{STAR},
detail AS (
  SELECT {_detail}
  FROM fact f
  JOIN dim_date d ON f.date_key = d.date_key
  JOIN dim_airline l ON f.airline_key = l.airline_key
  JOIN dim_airport o ON f.origin_airport_key = o.airport_key
  JOIN dim_airport t ON f.destination_airport_key = t.airport_key
)"""


def long(prefix: str, source: str, columns: dict[str, str], name: str, value: str) -> str:
    """One-row aggregate of `source` turned into (name, value) rows."""
    picks = ", ".join(f'{expr} AS "{key}"' for key, expr in columns.items())
    rows = "\nUNION ALL ".join(
        f"SELECT '{key}' AS {name}, CAST(\"{key}\" AS DOUBLE) AS {value} FROM onerow"
        for key in columns
    )
    return f"{prefix},\nonerow AS MATERIALIZED (SELECT {picks} FROM {source})\n{rows}"
