"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

`build_*` entries are the hand-over tables that the queries read (raw landing
rows, clean table, star schema, fitted statistics), each built once.  A query's
time covers its plan, its run and the transfer of nothing but a row count: the
result is written to the no-op sink, so no column is optimised away.
"""

from __future__ import annotations

import json
import os
import re
import time

from flightlake.catalog import QUERIES, Workspace
from flightlake.session import build_session

HEADLINE = """
clean_bts clean_compact dq_raw dq_clean dq_warehouse profile_missing profile_duplicates
fact_keys vw_flight_detail vw_overview_metrics vw_daily_performance vw_airline_performance
vw_origin_airport_performance vw_route_performance vw_departure_hour_performance
vw_delay_cause_by_airline vw_carrier_monthly_performance vw_airport_congestion_hourly
vw_delay_cascade_root_cause vw_high_risk_corridors dash_kpis dash_top_hubs dash_top_routes
ml_features ml_heuristic_pred ml_regression_metrics ml_auc score_blended score_tree_blend
ml_hist_first_tree ml_rate_importance profile_period
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session("flightlake-bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads

    times: dict[str, float] = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - start, 3)

    ws = Workspace.of(spark, sf_dir)
    timed("build_raw", lambda: ws.raw)
    timed("build_edge", lambda: ws.edge)
    timed("build_compact", lambda: ws.compact)
    timed("build_clean", lambda: ws.clean)
    timed("build_edge_clean", lambda: ws.edge_clean)
    timed("build_star", lambda: ws.star)
    timed("build_stats", lambda: (ws.stats, ws.baselines))
    for name in HEADLINE:
        run = QUERIES[name]
        timed(name, lambda: run(spark, sf_dir).write.format("noop").mode("overwrite").save())
    headline = sum(times[name] for name in HEADLINE)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(headline, 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
