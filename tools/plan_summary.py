"""Summarise the executed (final, post-AQE) physical plans of every catalogue query.

    python tools/plan_summary.py [--sf /root/testdata/sf0.01] [name ...] > PLANS.md

A query may run several Spark SQL executions: the rounds of a search, the passes of a fit, a
staged table.  All of them count, from Spark's event log: per query the executions, and summed
over them parquet scans, shuffle and broadcast exchanges, joins, windows, Python nodes
and any cartesian or nested-loop join.  The legs are expressions over the source that a query scans.
"""

from __future__ import annotations

import argparse
import json
import os
import re
import sys
import tempfile
from collections import Counter, defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COUNTERS = {
    "scans": r"^Scan (parquet|csv|text|binaryFile)|^Scan ExistingRDD",
    "shuffles": r"^Exchange",
    "broadcasts": r"^BroadcastExchange",
    "reused": r"^ReusedExchange",
    "smj": r"^SortMergeJoin",
    "bhj": r"^BroadcastHashJoin",
    "windows": r"^Window$",
    "python": r"ArrowEvalPython|FlatMapGroupsInPandas|MapInArrow|MapInPandas|BatchEvalPython",
    "cartesian": r"^CartesianProduct|^BroadcastNestedLoopJoin",
}


def nodes(plan: dict) -> list[str]:
    if plan["nodeName"].startswith("ReusedExchange"):  # what it reuses is counted where it is
        return [plan["nodeName"]]
    return [plan["nodeName"].strip(), *(n for c in plan["children"] for n in nodes(c))]


def executions(log_dir: str) -> dict[str, list[list[str]]]:
    """Node names of each execution's last plan, by the description it ran under."""
    plans: dict[int, dict] = {}
    names: dict[int, str] = {}
    for entry in os.scandir(log_dir):
        with open(entry.path) as lines:
            for line in lines:
                if "sparkPlanInfo" not in line:
                    continue
                event = json.loads(line)
                if "description" in event:
                    names[event["executionId"]] = event["description"]
                plans[event["executionId"]] = event["sparkPlanInfo"]
    out = defaultdict(list)
    for k, plan in plans.items():
        out[names.get(k, "")].append(nodes(plan))
    return out


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()

    from legworks.plans import catalog
    from legworks.plans.common import legs
    from legworks.session import get_session

    log_dir = tempfile.mkdtemp(prefix="plans-")
    spark = get_session(extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}",
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    queries, oracle = catalog.queries(), catalog.oracle()
    names = args.names or list(queries)
    legs(spark, args.sf)
    for name in names:
        spark.sparkContext.setJobDescription(name)
        queries[name](spark, args.sf).write.format("noop").mode("overwrite").save()
    spark.stop()
    ran = executions(log_dir)
    print(f"# Executed plans at {os.path.basename(args.sf)}\n")
    print("Generated by `tools/plan_summary.py` from Spark's event log: the nodes of all SQL "
          "executions of a query, searches and fits included. Scans read the source or "
          "written tables of the same query.\n")
    print("| query | oracle | executions | " + " | ".join(COUNTERS) + " |")
    print("| --- " * (len(COUNTERS) + 3) + "|")
    for name in names:
        total = Counter(k for plan in ran[name] for n in plan
                        for k, p in COUNTERS.items() if re.search(p, n))
        print(f"| {name} | {'SQL' if name in oracle else 'rows'} | {len(ran[name])} | "
              + " | ".join(str(total[k]) for k in COUNTERS) + " |")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
