"""Summarise the executed (post-AQE) physical plan of each headline query.

usage: python scripts/plan_report.py [--sf DIR] > PLANS.md

Counts, per query, the parquet scans, shuffle exchanges (and how many were
reused), broadcast exchanges, join strategies, window operators and any
Python / cartesian nodes, from the plan Spark actually ran.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

NODES = {
    "scans": r"FileScan parquet|Scan parquet",
    "shuffles": r"\bShuffleExchange|\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition|\bExchange RoundRobin",
    "reused": r"ReusedExchange",
    "broadcasts": r"BroadcastExchange",
    "bhj": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "windows": r"\bWindow \[",
    "window_limit": r"WindowGroupLimit",
    "python": r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas",
    "cartesian": r"CartesianProduct|BroadcastNestedLoopJoin",
}


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    args = ap.parse_args()
    from bench import HEADLINE
    from tessera.plans.catalog import QUERIES
    from tessera.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8)
    print("# Executed plans of the headline queries\n")
    print(f"Data: `{args.sf}`; final AQE plans after one run. Queries that write an")
    print("intermediate (`materialize`) count that job's plan separately, not here.\n")
    print("| Query | " + " | ".join(NODES) + " |")
    print("|---|" + "---|" * len(NODES))
    for key in HEADLINE:
        df = QUERIES[key](spark, args.sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = [len(re.findall(p, plan)) for p in NODES.values()]
        print(f"| `{key}` | " + " | ".join(str(c) for c in counts) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
