"""SQL for features, baselines, evaluation and scoring."""

from __future__ import annotations

from flightlake import contracts as K
from flightlake.ml.score import SENTENCES
from oracle.base import CLEAN, long, r

SQL: dict[str, str] = {}

_POP = f"""{CLEAN},
pop AS MATERIALIZED (
  SELECT * FROM clean WHERE flight_status = 'Completed'
    AND arrival_delay_minutes IS NOT NULL AND arrival_delayed_15 IS NOT NULL
),
train AS (SELECT * FROM pop WHERE day_of_month <= 23),
test AS (SELECT * FROM pop WHERE day_of_month >= 24)"""
_STATS = f"""{_POP},
overall AS MATERIALIZED (
  SELECT count(*) AS flights, avg(arrival_delayed_15) AS rate, avg(arrival_delay_minutes) AS delay FROM train
),
carrier AS MATERIALIZED (
  SELECT reporting_airline_code, count(*) AS n, avg(arrival_delayed_15) AS rate,
    avg(arrival_delay_minutes) AS delay
  FROM train GROUP BY reporting_airline_code
),
route AS MATERIALIZED (
  SELECT route_code, count(*) AS n,
    (avg(arrival_delayed_15) * count(*) + (SELECT rate FROM overall) * 30) / (count(*) + 30) AS rate,
    avg(arrival_delay_minutes) AS delay
  FROM train GROUP BY route_code
)"""
SQL["ml_population"] = f"""{_POP}
SELECT flight_number, flight_date, route_code, arrival_delayed_15, arrival_delay_minutes FROM pop"""
SQL["ml_split_counts"] = f"""{_POP}
SELECT 'train' AS part, count(*) AS flights FROM train
UNION ALL SELECT 'test', count(*) FROM test"""
SQL["ml_carrier_stats"] = f"""{_STATS}
SELECT reporting_airline_code, n AS carrier_flights, {r('rate', 6)} AS carrier_historical_delay_rate,
  {r('delay', 6)} AS carrier_avg_delay_minutes
FROM carrier"""
SQL["ml_route_stats"] = f"""{_STATS}
SELECT route_code, n AS route_flights, {r('rate', 6)} AS route_congestion_index,
  {r('delay', 6)} AS route_avg_delay_minutes
FROM route"""
SQL["ml_global_stats"] = f"""{_STATS}
SELECT flights, {r('rate', 6)} AS global_delay_rate, {r('delay', 6)} AS global_avg_delay FROM overall"""
SQL["ml_stats_roundtrip"] = f"""{_STATS}
SELECT 'carrier' AS level, reporting_airline_code AS code, {r('rate', 6)} AS rate,
  {r('delay', 6)} AS delay FROM carrier
UNION ALL
SELECT 'route', route_code, {r('rate', 6)}, {r('delay', 6)} FROM route"""
SQL["find_padded_routes"] = f"""{_STATS}
SELECT route_code, {r('rate', 6)} AS route_congestion_index, {r('delay')} AS route_avg_delay_minutes
FROM route WHERE rate >= (SELECT quantile_cont(rate, 0.9) FROM route)"""
_FEATURED = f"""{_STATS},
featured AS MATERIALIZED (
  SELECT f.*, CAST(f.is_weekend AS INTEGER) AS is_weekend_flag,
    coalesce(c.rate, (SELECT rate FROM overall)) AS carrier_historical_delay_rate,
    coalesce(c.delay, (SELECT delay FROM overall)) AS carrier_avg_delay_minutes,
    coalesce(t.rate, (SELECT rate FROM overall)) AS route_congestion_index,
    coalesce(t.delay, (SELECT delay FROM overall)) AS route_avg_delay_minutes,
    sin(2 * pi() * f.scheduled_departure_hour / 24) AS departure_hour_sin,
    cos(2 * pi() * f.scheduled_departure_hour / 24) AS departure_hour_cos,
    CASE WHEN f.scheduled_departure_hour IN (7, 8, 9, 17, 18, 19, 20) THEN 1 ELSE 0 END AS is_peak_hour,
    CASE WHEN f.scheduled_departure_hour <= 5 THEN 1 ELSE 0 END AS is_red_eye
  FROM test f
  LEFT JOIN carrier c ON f.reporting_airline_code = c.reporting_airline_code
  LEFT JOIN route t ON f.route_code = t.route_code
)"""
_round6 = """carrier_historical_delay_rate carrier_avg_delay_minutes route_congestion_index
route_avg_delay_minutes departure_hour_sin departure_hour_cos""".split()
SQL["ml_features"] = f"""{_FEATURED}
SELECT flight_number, flight_date,
  {', '.join(f'{r(c, 6)} AS {c}' if c in _round6 else c for c in K.FEATURE_COLUMNS)}
FROM featured"""

# ---- baselines and evaluation

_BASE = f"""{_FEATURED},
naive AS MATERIALIZED (
  SELECT quantile_cont(arrival_delay_minutes, 0.5) AS median, avg(arrival_delayed_15) AS rate FROM train
),
pair AS (
  SELECT route_code, reporting_airline_code, quantile_cont(arrival_delay_minutes, 0.5) AS m
  FROM train GROUP BY ALL
),
line AS (
  SELECT reporting_airline_code, quantile_cont(arrival_delay_minutes, 0.5) AS m FROM train GROUP BY ALL
),
scored AS MATERIALIZED (
  SELECT f.*, coalesce(p.m, l.m, (SELECT median FROM naive)) AS heuristic,
    (SELECT median FROM naive) AS naive_minutes, (SELECT rate FROM naive) AS naive_rate
  FROM featured f
  LEFT JOIN pair p ON f.route_code = p.route_code AND f.reporting_airline_code = p.reporting_airline_code
  LEFT JOIN line l ON f.reporting_airline_code = l.reporting_airline_code
)"""
SQL["ml_baselines"] = f"""{_BASE}
SELECT {r('median', 6)} AS global_median, {r('rate', 6)} AS global_delay_rate FROM naive"""
SQL["ml_heuristic_pred"] = f"""{_BASE}
SELECT flight_number, flight_date, route_code, reporting_airline_code, heuristic FROM scored"""


def _regression(label: str, p: str) -> str:
    y = "arrival_delay_minutes"
    return f"""SELECT '{label}' AS model,
  {r(f'avg(abs({y} - {p}))', 3)} AS mae_minutes,
  {r(f'sqrt(avg(({y} - {p}) * ({y} - {p})))', 3)} AS rmse_minutes,
  {r(f'quantile_cont(abs({y} - {p}), 0.5)', 3)} AS median_ae_minutes,
  {r(f'100.0 * avg(abs(({y} - {p}) / {y})) FILTER (WHERE {y} <> 0)')} AS mape_pct,
  {r(f'1 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * count(*))', 4)} AS r2
FROM scored"""


_naive_reg = _regression("Naive Global Median", "naive_minutes")
_heur_reg = _regression("Route x Carrier Heuristic", "heuristic")
SQL["ml_regression_metrics"] = f"{_BASE}\n{_naive_reg}\nUNION ALL\n{_heur_reg}"


def _auc(score: str) -> str:
    """Mann-Whitney form: average rank of the positives."""
    return f"""(SELECT (sum(mid) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1)
      * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
      / (CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) * count(*) FILTER (WHERE y = 0))
    FROM (SELECT arrival_delayed_15 AS y,
      rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0 AS mid
      FROM scored))"""


def _classes(label: str, score: str) -> str:
    tp = f"count(*) FILTER (WHERE arrival_delayed_15 = 1 AND {score} >= 0.5)"
    fp = f"count(*) FILTER (WHERE arrival_delayed_15 = 0 AND {score} >= 0.5)"
    fn = f"count(*) FILTER (WHERE arrival_delayed_15 = 1 AND {score} < 0.5)"
    right = f"count(*) FILTER (WHERE (arrival_delayed_15 = 1) = ({score} >= 0.5))"

    def safe(a: str, b: str) -> str:
        return r(f"coalesce(CAST({a} AS DOUBLE) / NULLIF({b}, 0), 0)", 4)

    return f"""SELECT '{label}' AS model, {r(_auc(score), 4)} AS roc_auc,
  {safe(right, 'count(*)')} AS accuracy, {safe(tp, f'({tp} + {fp})')} AS precision,
  {safe(tp, f'({tp} + {fn})')} AS recall, {safe(f'2 * {tp}', f'(2 * {tp} + {fp} + {fn})')} AS f1
FROM scored"""


_naive_cls = _classes("Naive Rate Baseline", "naive_rate")
SQL["ml_classification_metrics"] = (
    f"{_BASE}\n{_naive_cls}\nUNION ALL\n{_classes('Route Congestion Index', 'route_congestion_index')}"
)
SQL["ml_auc"] = f"""{_BASE}
SELECT 'route_congestion_index' AS score, {r(_auc('route_congestion_index'), 6)} AS auc
UNION ALL
SELECT 'carrier_historical_delay_rate', {r(_auc('carrier_historical_delay_rate'), 6)}"""
_e = "(arrival_delay_minutes - heuristic)"
SQL["ml_residuals"] = long(
    _BASE,
    "scored",
    {
        "mean_residual": r(f"avg{_e}", 3),
        "std_residual": r(f"stddev_pop{_e}", 3),
        "pct_residual_negative": r(f"100.0 * count(*) FILTER (WHERE {_e} < 0) / count(*)"),
        "pct_residual_positive": r(f"100.0 * count(*) FILTER (WHERE {_e} > 0) / count(*)"),
        "p95_absolute_error": r(f"quantile_cont(abs{_e}, 0.95)", 1),
        "p99_absolute_error": r(f"quantile_cont(abs{_e}, 0.99)", 1),
    },
    "metric",
    "value",
)
_reg_metrics = ["mae_minutes", "rmse_minutes", "median_ae_minutes", "mape_pct", "r2"]
_cls_metrics = ["roc_auc", "accuracy", "precision", "recall", "f1"]
_rows = [f"SELECT model, '{m}' AS metric, {m} AS value FROM regs" for m in _reg_metrics]
_rows += [f"SELECT model, '{m}', {m} FROM classes" for m in _cls_metrics]
SQL["ml_tier_comparison"] = f"""{_BASE},
regs AS MATERIALIZED ({_naive_reg} UNION ALL {_heur_reg}),
classes AS MATERIALIZED ({_naive_cls})
""" + "\nUNION ALL ".join(_rows)

# ---- scoring


def _pick(values: list[float], first: int, column: str) -> str:
    body = ", ".join(str(v) for v in values)
    last = first + len(values) - 1
    return f"CAST([{body}] AS DOUBLE[])[greatest({first}, least({column}, {last})) - {first - 1}]"


_MULT = f"""{_pick(K.HOUR_MULTIPLIERS, 5, 'scheduled_departure_hour')} AS hour_multiplier,
  {_pick(K.WEEKDAY_MULTIPLIERS, 1, 'day_of_week')} AS weekday_multiplier,
  {_pick(K.DISTANCE_MULTIPLIERS, 1, 'distance_group')} AS distance_multiplier,
  CAST(CASE WHEN is_weekend THEN 1.05 ELSE 1.0 END AS DOUBLE) AS weekend_multiplier"""
SQL["score_multipliers"] = f"""{CLEAN},
used AS (
  SELECT scheduled_departure_hour, day_of_week, distance_group, is_weekend, count(*) AS flights
  FROM clean GROUP BY ALL
)
SELECT *, {_MULT} FROM used"""
_SCORED = f"""{_STATS},
factors AS (
  SELECT f.flight_number, f.flight_date, f.reporting_airline_code, f.route_code, {_MULT},
    coalesce(t.rate, g.rate) AS base_rate, coalesce(t.delay, g.delay) AS base_delay,
    coalesce(c.rate, g.rate) / g.rate AS rate_ratio,
    coalesce(c.delay, g.delay) / g.delay AS delay_ratio
  FROM clean f CROSS JOIN overall g
  LEFT JOIN route t ON f.route_code = t.route_code
  LEFT JOIN carrier c ON f.reporting_airline_code = c.reporting_airline_code
),
risk AS MATERIALIZED (
  SELECT *,
    greatest(0.04, least((base_rate * 0.60 + base_rate * rate_ratio * 0.40)
      * (hour_multiplier * weekday_multiplier * weekend_multiplier), 0.90)) AS p,
    greatest(0.0, (base_delay * 0.60 + base_delay * delay_ratio * 0.40)
      * (hour_multiplier * weekday_multiplier * weekend_multiplier) * distance_multiplier) AS m
  FROM factors
)"""
_keys = "flight_number, flight_date, reporting_airline_code, route_code"
_tier = "CASE WHEN p < 0.20 THEN 'low' WHEN p < 0.40 THEN 'moderate' ELSE 'high' END"
SQL["score_blended"] = f"""{_SCORED}
SELECT {_keys}, {r('p', 4)} AS delay_probability, {r('p * 100', 1)} AS delay_probability_pct,
  {r('m', 1)} AS estimated_delay_minutes, {_tier} AS risk_level, {r('m * 101.90')} AS cost_impact_usd
FROM risk"""
SQL["score_factors"] = f"""{_SCORED}
SELECT {_keys}, {r('base_delay', 1)} AS route_baseline_delay_min,
  {r('(rate_ratio - 1.0) * base_rate * 0.40 * 100', 1)} AS carrier_delta_pct,
  {r('(hour_multiplier - 1.0) * base_rate * 100', 1)} AS hour_delta_pct,
  {r('(weekday_multiplier - 1.0) * base_rate * 100', 1)} AS dow_delta_pct,
  {r('hour_multiplier')} AS hour_multiplier, {r('weekday_multiplier')} AS dow_multiplier
FROM risk"""


def _sentence(tier: str) -> str:
    parts = SENTENCES[tier].replace("{p}", "\0p\0").replace("{m}", "\0m\0").split("\0")
    shown = {
        "p": "CAST(CAST(round_even(p * 100, 0) AS INTEGER) AS VARCHAR)",
        "m": "CAST(CAST(round_even(m, 0) AS INTEGER) AS VARCHAR)",
    }
    return " || ".join(shown.get(x, f"'{x}'") for x in parts)


SQL["score_interpretation"] = f"""{_SCORED}
SELECT {_tier} AS risk_level, CASE WHEN p < 0.20 THEN {_sentence('low')}
  WHEN p < 0.40 THEN {_sentence('moderate')} ELSE {_sentence('high')} END AS interpretation,
  count(*) AS flights
FROM risk GROUP BY ALL"""
SQL["score_risk_mix"] = f"""{_SCORED}
SELECT reporting_airline_code, count(*) FILTER (WHERE {_tier} = 'low') AS low_risk,
  count(*) FILTER (WHERE {_tier} = 'moderate') AS moderate_risk,
  count(*) FILTER (WHERE {_tier} = 'high') AS high_risk
FROM risk GROUP BY reporting_airline_code"""
