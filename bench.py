"""Benchmark the headline queries.

Runs each query once to warm up, then ``BENCH_RUNS`` timed runs (default 3),
and prints ONE JSON line:
  {"metric": "total_median_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each run builds the plan and executes it fully into Spark's ``noop`` sink, so
nothing is collected to the driver. Environment:
  BENCH_SF_DIR  data directory (default /root/testdata/sf0.1)
  BENCH_CPUS    local[N] (default 8)
  BENCH_KEYS    comma-separated subset of keys (default: HEADLINE)
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "budget_forecast", "campaign_revenue", "usage_by_student", "lesson_summary",
    "activity_scores", "retail_q1", "retail_q2", "retail_q3", "retail_q4", "retail_q5",
    "insert_if_absent", "dq_self_foreign_key",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    keys = [k for k in os.environ.get("BENCH_KEYS", "").split(",") if k] or HEADLINE

    from tessera.plans.catalog import QUERIES
    from tessera.session import build_session

    spark = build_session(f"local[{cpus}]", app_name="tessera-bench", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    timings: dict[str, float] = {}
    rows: dict[str, int] = {}
    for key in keys:
        fn = QUERIES[key]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        timings[key] = round(statistics.median(samples), 3)
        rows[key] = fn(spark, sf_dir).count()
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_median_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "rows": rows,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
