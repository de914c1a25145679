"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is built and fully executed into the no-op sink (every row is
produced, nothing is collected).  The first run of a query pays plan
compilation and JIT warm-up ("cold"); the reported time is the best of the
following warm runs -- the steady state that matters on large data.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean",
    "cleaning_report",
    "track_legs",
    "vessel_metrics",
    "top_vessels",
    "fleet_statistics",
    "comprehensive_report",
    "daily_traffic",
    "active_vessels",
    "recent_positions",
    "data_quality_raw",
    "index_files",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    warm_runs = int(os.environ.get("BENCH_WARM_RUNS", "2"))
    from trackline.plans.queries import QUERIES
    from trackline.session import local_session

    spark = local_session(cpus, cpus, app="trackline-bench")

    def run(key: str) -> float:
        t0 = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    cold, warm = {}, {}
    for key in HEADLINE:
        cold[key] = round(run(key), 3)
    for key in HEADLINE:
        warm[key] = round(min(run(key) for _ in range(warm_runs)), 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_warm",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "cold_total": round(sum(cold.values()), 3),
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
