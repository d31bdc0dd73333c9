"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the data, BENCH_CPUS (default 8) the local threads. Every query is
run to completion with a write that discards the rows; kept frames are freed before each run. The best of BENCH_RUNS
(default 2) runs counts, the first one is listed beside it.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lagline.plans import catalog  # noqa: E402
from lagline.session import build_session  # noqa: E402

HEADLINE = [
    "ag_response_summary", "ag_iqr_outliers", "ag_threshold_risk", "ag_hourly", "ag_exact_percentile", "ag_risk_score",
    "ag_location_features", "ag_gold_summary", "dq_missing_pct", "dd_composite", "rs_pivot", "wn_calls_citywide",
    "wn_calls_by_area", "plan_dispatch_model", "plan_station_model", "pr_model_ready", "src_csv_stream", "sink_table",
    "sv_km", "sv_km_stratified", "sv_km_thresholds", "sv_hazard_binned", "sv_logrank_suite", "sv_hr_table", "ml_gbt_reg",
    "ml_quantile", "ml_shap", "ml_forecast", "ml_kmeans",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))
    catalog.QUERIES["ag_count_by"](spark, folder).count()  # start-up is no query's cost
    times, first = {}, {}
    for name in names:
        took = []
        for _ in range(runs):
            catalog.forget()
            start = time.perf_counter()
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        times[name], first[name] = round(min(took), 3), round(took[0], 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "first_runs": first, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
