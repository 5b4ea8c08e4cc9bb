"""SQL for the star schema, the reporting views and the dashboard."""

from __future__ import annotations

from flightlake import contracts as K
from oracle.base import CLEAN, DETAIL, DIM_CTES, EDGE_CLEAN, STAR, big, pct, r

SQL: dict[str, str] = {}

# ---- star schema

_DIMS = f"{CLEAN},{DIM_CTES}"
SQL["dim_date"] = f"{_DIMS}\nSELECT * FROM dim_date"
SQL["dim_airline"] = f"{_DIMS}\nSELECT * FROM dim_airline"
SQL["dim_airport"] = f"{_DIMS}\nSELECT * FROM dim_airport"
SQL["dim_conflicts"] = f"""{EDGE_CLEAN},{DIM_CTES}
SELECT airport_id, count(*) AS variants FROM airports
WHERE airport_id IS NOT NULL GROUP BY airport_id HAVING count(*) > 1"""
SQL["dim_upsert"] = f"""{_DIMS},
known AS (SELECT * FROM dim_airport WHERE airport_id < 10010),
fresh AS (SELECT * FROM dim_airport WHERE airport_id >= 10010)
SELECT airport_key, airport_id, airport_code, 'New ' || city_name AS city_name, state_code, state_name
FROM known
UNION ALL
SELECT CAST((SELECT max(airport_key) FROM known) + row_number() OVER (ORDER BY airport_id) AS INTEGER),
  airport_id, airport_code, 'New ' || city_name, state_code, state_name
FROM fresh"""
_key = ", ".join(K.CLEAN_KEY)
SQL["fact_keys"] = f"""{CLEAN}
SELECT row_number() OVER (ORDER BY flight_date, reporting_airline_id, flight_number,
  origin_airport_id, scheduled_departure_time, destination_airport_id) AS flight_key, {_key}
FROM clean"""
SQL["wh_fact"] = f"{STAR}\nSELECT flight_key, {', '.join(K.FACT_COLUMNS)} FROM fact"
SQL["load_counts"] = f"""{STAR}
SELECT 'dim_date' AS table_name, count(*) AS row_count FROM dim_date
UNION ALL SELECT 'dim_airline', count(*) FROM dim_airline
UNION ALL SELECT 'dim_airport', count(*) FROM dim_airport
UNION ALL SELECT 'fact_flight', count(*) FROM fact"""
SQL["incr_new_facts"] = f"""{STAR}
SELECT {', '.join(K.FACT_NATURAL_KEY)} FROM fact
WHERE date_key // 100 = (SELECT max(date_key) // 100 FROM fact)"""
SQL["incr_ledger"] = f"""{CLEAN},
busy AS (
  SELECT year(flight_date) AS y, month(flight_date) AS m FROM clean GROUP BY ALL ORDER BY count(*) DESC, y, m LIMIT 1
),
month AS (
  SELECT y, m, count(*) AS n, count(*) FILTER (WHERE day(flight_date) <= 15) AS half
  FROM clean, busy WHERE year(flight_date) = y AND month(flight_date) = m GROUP BY ALL
)
SELECT d.delivery, d.outcome, CAST(y AS INTEGER) AS reporting_year, CAST(m AS INTEGER) AS reporting_month,
  CASE d.delivery WHEN 'corrected' THEN n ELSE half END AS source_row_count,
  CASE d.delivery WHEN 'corrected' THEN n - half ELSE half END AS loaded_row_count, n AS facts, n AS top_key
FROM month, (VALUES ('half', 'complete'), ('corrected', 'complete'), ('renamed', 'skipped')) d(delivery, outcome)"""
SQL["load_guard"] = f"""{CLEAN}
SELECT s.step, s.outcome, CAST(s.version AS INTEGER) AS version, count(*) AS fact_rows FROM clean,
  (VALUES ('first', 'loaded', 1), ('again', 'refused', 1), ('replace', 'loaded', 2)) s(step, outcome, version)
GROUP BY ALL"""

# ---- views

_n = "count(*)"
_done = "count(*) FILTER (WHERE flight_status = 'Completed')"
_cancelled = "count(*) FILTER (WHERE flight_status = 'Cancelled')"
_diverted = "count(*) FILTER (WHERE flight_status = 'Diverted')"
_eligible = "count(*) FILTER (WHERE arrival_on_time IS NOT NULL)"
_on_time = "count(*) FILTER (WHERE arrival_on_time)"
_late = "count(*) FILTER (WHERE NOT arrival_on_time)"
_M = {
    "total_flights": _n,
    "departing_flights": _n,
    "completed_flights": _done,
    "cancelled_flights": _cancelled,
    "diverted_flights": _diverted,
    "eligible_arrivals": _eligible,
    "on_time_arrivals": _on_time,
    "delayed_arrivals": _late,
    "on_time_arrival_rate_percentage": pct(_on_time, _eligible),
    "cancellation_rate_percentage": pct(_cancelled, _n),
    "average_signed_arrival_delay_minutes": r("avg(arrival_delay_minutes_signed)"),
    "average_arrival_delay_minutes": r("avg(arrival_delay_minutes)"),
    "average_signed_departure_delay_minutes": r("avg(departure_delay_minutes_signed)"),
    "median_signed_arrival_delay_minutes": r("quantile_cont(arrival_delay_minutes_signed, 0.5)"),
    "average_taxi_out_minutes": r("avg(taxi_out_minutes)"),
    "average_distance_miles": r("avg(distance_miles)"),
    "total_reported_delay_minutes": big("sum(total_reported_delay_minutes)"),
}


def _view(keys: str, measures: str) -> str:
    picks = ", ".join(f"{_M[m]} AS {m}" for m in measures.split())
    if not keys:
        return f"{DETAIL}\nSELECT {picks} FROM detail"
    return f"{DETAIL}\nSELECT {keys}, {picks} FROM detail GROUP BY {keys}"


_rates = "on_time_arrival_rate_percentage cancellation_rate_percentage"
_status = "completed_flights cancelled_flights diverted_flights"
_arrivals = "on_time_arrivals delayed_arrivals"
SQL["vw_flight_detail"] = f"{DETAIL}\nSELECT * FROM detail"
SQL["vw_overview_metrics"] = _view(
    "",
    f"total_flights {_status} eligible_arrivals {_arrivals} {_rates} "
    "average_signed_arrival_delay_minutes average_arrival_delay_minutes "
    "median_signed_arrival_delay_minutes total_reported_delay_minutes",
)
SQL["vw_daily_performance"] = _view(
    "flight_date, day_name, is_weekend",
    f"total_flights {_status} {_arrivals} {_rates} average_signed_arrival_delay_minutes "
    "total_reported_delay_minutes",
)
SQL["vw_airline_performance"] = _view(
    "reporting_airline_id, reporting_airline_code",
    f"total_flights {_status} eligible_arrivals {_arrivals} {_rates} "
    "average_signed_arrival_delay_minutes average_signed_departure_delay_minutes "
    "median_signed_arrival_delay_minutes average_taxi_out_minutes total_reported_delay_minutes",
)
SQL["vw_origin_airport_performance"] = _view(
    "origin_airport_id, origin_airport_code, origin_city_name, origin_state_code, origin_state_name",
    f"departing_flights {_status} {_arrivals} {_rates} average_signed_departure_delay_minutes "
    "average_signed_arrival_delay_minutes average_taxi_out_minutes",
)
SQL["vw_route_performance"] = _view(
    "route_code, origin_airport_id, origin_airport_code, origin_city_name, origin_state_code, "
    "destination_airport_id, destination_airport_code, destination_city_name, "
    "destination_state_code",
    f"total_flights {_status} {_arrivals} {_rates} average_signed_arrival_delay_minutes "
    "average_distance_miles",
)
SQL["vw_departure_hour_performance"] = _view(
    "scheduled_departure_hour",
    f"total_flights cancelled_flights {_arrivals} {_rates} average_signed_arrival_delay_minutes",
)
_causes = "\nUNION ALL ".join(
    f"SELECT reporting_airline_id, reporting_airline_code, flights_with_reported_delay_causes, "
    f"'{label}' AS delay_cause, {c} AS minutes FROM wide"
    for c, label in K.DELAY_CAUSES.items()
)
_cause_sums = ", ".join(f"sum({c}) AS {c}" for c in K.CAUSE_COLUMNS)
SQL["vw_delay_cause_by_airline"] = f"""{DETAIL},
wide AS (
  SELECT reporting_airline_id, reporting_airline_code,
    count(*) FILTER (WHERE delay_cause_reported) AS flights_with_reported_delay_causes, {_cause_sums}
  FROM detail GROUP BY reporting_airline_id, reporting_airline_code
),
tall AS ({_causes})
SELECT reporting_airline_id, reporting_airline_code, flights_with_reported_delay_causes, delay_cause,
  {big('minutes')} AS total_delay_minutes,
  {pct('minutes', 'sum(minutes) OVER (PARTITION BY reporting_airline_id)')}
    AS airline_delay_share_percentage
FROM tall"""
SQL["vw_carrier_monthly_performance"] = f"""{DETAIL}
SELECT reporting_airline_code, year_number, month_number, count(*) AS total_flights,
  {_done} AS completed_flights, {pct(_on_time, _n)} AS otp_15_pct,
  {r('avg(arrival_delay_minutes)')} AS avg_delay_minutes,
  {big('sum(arrival_delay_minutes) * 101.90')} AS total_delay_cost_usd
FROM detail GROUP BY reporting_airline_code, year_number, month_number"""
_flagged = "count(*) FILTER (WHERE arrival_delayed_15)"
SQL["vw_airport_congestion_hourly"] = f"""{DETAIL}
SELECT origin_airport_code AS airport_code, origin_city_name AS city_name, scheduled_departure_hour,
  count(*) AS departures_count, {r('avg(departure_delay_minutes)')} AS avg_departure_delay,
  {r('avg(arrival_delay_minutes)')} AS avg_arrival_delay, {pct(_flagged, _n)} AS delay_risk_pct
FROM detail GROUP BY ALL"""
SQL["vw_delay_cascade_root_cause"] = f"""{DETAIL}
SELECT reporting_airline_code, sum(carrier_delay_minutes) AS carrier_delay_min,
  sum(weather_delay_minutes) AS weather_delay_min,
  sum(national_air_system_delay_minutes) AS nas_delay_min,
  sum(late_aircraft_delay_minutes) AS late_aircraft_delay_min,
  {pct('sum(late_aircraft_delay_minutes)', 'sum(total_reported_delay_minutes)')} AS cascade_pct
FROM detail WHERE delay_cause_reported GROUP BY reporting_airline_code"""
SQL["vw_high_risk_corridors"] = f"""{DETAIL}
SELECT route_code, origin_airport_code AS origin_code, destination_airport_code AS dest_code,
  count(*) AS flight_count, {r('avg(arrival_delay_minutes)')} AS avg_delay_minutes,
  {pct(_flagged, _n)} AS delay_probability_pct,
  {big('sum(arrival_delay_minutes) * 101.90')} AS total_financial_exposure_usd
FROM detail GROUP BY ALL HAVING count(*) >= 200"""

# ---- dashboard

_DONE = f"{CLEAN},\ndone AS (SELECT * FROM clean WHERE flight_status = 'Completed')"
_otp = pct(_on_time, "count(arrival_on_time)")
_late15 = pct("count(*) FILTER (WHERE arrival_delayed_15 = 1)", "count(arrival_delayed_15)")
_mean = r("avg(arrival_delay_minutes)")
SQL["dash_filtered"] = f"""{CLEAN}
SELECT 'chosen' AS filter, flight_number, flight_date, reporting_airline_code, route_code, flight_status FROM clean
WHERE reporting_airline_code IN (SELECT DISTINCT reporting_airline_code FROM clean ORDER BY 1 LIMIT 2)
  AND origin_airport_code IN (SELECT origin_airport_code FROM clean GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3)
  AND flight_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'
UNION ALL
SELECT 'empty lists', flight_number, flight_date, reporting_airline_code, route_code, flight_status FROM clean
WHERE flight_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"""
_period = "FROM clean WHERE flight_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'"
_sketched = ["reporting_airline_id", "origin_airport_id", "destination_airport_id", "route_code", "flight_number"]
SQL["profile_period"] = f"{CLEAN}\nSELECT 'flights' AS metric, count(*) AS exact_count, true AS within_bound {_period}" + "".join(
    f"\nUNION ALL SELECT '{c}', count(DISTINCT {c}), true {_period}" for c in _sketched
)
SQL["dash_options"] = f"""{CLEAN}
SELECT DISTINCT 'carrier' AS option, reporting_airline_code AS value FROM clean
UNION ALL SELECT 'first_date', CAST(min(flight_date) AS VARCHAR) FROM clean
UNION ALL SELECT 'last_date', CAST(max(flight_date) AS VARCHAR) FROM clean"""
SQL["dash_top_origins"] = f"""{CLEAN}
SELECT origin_airport_code, count(*) AS flights FROM clean GROUP BY 1
ORDER BY flights DESC, origin_airport_code LIMIT 30"""
SQL["dash_kpis"] = f"""{_DONE}
SELECT (SELECT count(*) FROM clean) AS total_flights, count(*) AS completed_flights,
  (SELECT {_cancelled} FROM clean) AS cancelled_flights,
  (SELECT {_diverted} FROM clean) AS diverted_flights, {_on_time} AS on_time_arrivals,
  {pct(_on_time, _n)} AS otp_pct,
  count(*) FILTER (WHERE arrival_delayed_15 = 1) AS delayed_flights, {_mean} AS avg_arrival_delay,
  {r('avg(departure_delay_minutes)')} AS avg_departure_delay,
  {big('sum(arrival_delay_minutes)')} AS total_delay_minutes,
  {big('sum(arrival_delay_minutes) * 101.90')} AS total_cost_usd,
  (SELECT {pct(_cancelled, _n)} FROM clean) AS cancellation_rate_pct
FROM done"""
SQL["dash_hour_cascade"] = f"""{_DONE}
SELECT scheduled_departure_hour, {_mean} AS avg_delay, {_late15} AS delay_rate,
  count(flight_number) AS flight_volume
FROM done GROUP BY 1 HAVING scheduled_departure_hour BETWEEN 5 AND 23"""
_labels = {
    "Late Aircraft Cascade": "late_aircraft_delay_minutes",
    "Air Carrier Control": "carrier_delay_minutes",
    "National Airspace (NAS)": "national_air_system_delay_minutes",
    "Severe Weather": "weather_delay_minutes",
    "Security Incident": "security_delay_minutes",
}
_tall = "\nUNION ALL ".join(
    f"SELECT '{label}' AS cause, sum({c}) AS minutes FROM done" for label, c in _labels.items()
)
SQL["dash_cause_breakdown"] = f"""{_DONE},
tall AS ({_tall})
SELECT cause, {big('minutes')} AS minutes,
  {pct('minutes', '(SELECT sum(minutes) FROM tall)')} AS percentage
FROM tall"""
SQL["dash_daily"] = f"""{_DONE}
SELECT flight_date, count(flight_number) AS total_flights, {_otp} AS otp, {_mean} AS avg_delay
FROM done GROUP BY flight_date"""
SQL["dash_carrier_ranking"] = f"""{_DONE}
SELECT reporting_airline_code, count(flight_number) AS total_flights, {_otp} AS otp,
  {_mean} AS avg_delay
FROM done GROUP BY reporting_airline_code"""
SQL["dash_top_hubs"] = f"""{_DONE}
SELECT origin_airport_code, count(flight_number) AS flight_volume, {_late15} AS delay_rate,
  {_mean} AS avg_delay
FROM done GROUP BY origin_airport_code HAVING count(flight_number) >= 2000
ORDER BY delay_rate DESC, origin_airport_code LIMIT 15"""
SQL["dash_top_routes"] = f"""{_DONE}
SELECT route_code, count(flight_number) AS volume, {_mean} AS avg_delay, {_late15} AS delay_rate,
  {big('sum(arrival_delay_minutes) * 101.90')} AS total_delay_cost
FROM done GROUP BY route_code HAVING count(flight_number) >= 200
ORDER BY avg_delay DESC, route_code LIMIT 20"""
SQL["dash_carrier_preview"] = f"""{_DONE}
SELECT reporting_airline_code, count(flight_number) AS total_flights, {_otp} AS otp_15_pct,
  {_mean} AS avg_delay_min,
  {big('sum(arrival_delay_minutes) * 101.90 / 1000000.0')} AS cost_exposure_musd
FROM done GROUP BY reporting_airline_code"""
SQL["find_hub_buffers"] = f"""{_DONE}
SELECT origin_airport_code, count(*) AS flights,
  {big('sum(late_aircraft_delay_minutes)')} AS late_aircraft_minutes,
  {big('sum(total_reported_delay_minutes)')} AS reported_minutes,
  {pct('sum(late_aircraft_delay_minutes)', 'sum(total_reported_delay_minutes)')}
    AS late_aircraft_share_pct
FROM done WHERE scheduled_departure_hour >= 16 GROUP BY origin_airport_code"""
SQL["find_reserve_carriers"] = f"""{_DONE}
SELECT reporting_airline_code, count(flight_number) AS total_flights, {_late15} AS delay_rate_pct,
  {big('sum(carrier_delay_minutes) * 101.90')} AS carrier_delay_cost_usd,
  {_late15} > quantile_cont({_late15}, 0.5) OVER () AS reserve
FROM done GROUP BY reporting_airline_code"""
