"""Summarise the physical plan of every registered query (writes PLANS.md).

Usage: python tools/plan_report.py [sf_dir] > PLANS.md

Two plans per query: as planned on ``sf_dir`` with the default broadcast
threshold (Catalyst broadcasts sides whose size estimate is under 10 MB), and
with a 64 KB threshold, under which every table whose size grows with the data
is shuffled while the fixed-size dimensions (nation: 25 rows, region: 5) stay
broadcast: the shape the plans take at 100 TB. Counts are of physical operators
before AQE re-planning.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.plans.queries import QUERIES  # noqa: E402
from ledgerlake.session import local_session  # noqa: E402

PATTERNS = {
    "scans": r"FileScan ",
    "shuffles": r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)",
    "single-partition": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "SMJ": r"SortMergeJoin",
    "BHJ": r"BroadcastHashJoin",
    "SHJ": r"ShuffledHashJoin",
    "hash aggs": r"HashAggregate\(",
    "sort aggs": r"SortAggregate\(",
    "windows": r"\bWindow ",
    "subqueries": r"Subquery subquery",
    "top-k": r"TakeOrderedAndProject",
    "python": r"(BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas)",
    "cartesian": r"(CartesianProduct|BroadcastNestedLoopJoin)",
}


def summary(plan: str) -> dict[str, int]:
    return {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    qs = QUERIES
    rows = []
    for name, q in qs.items():
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        small = summary(q(spark, sf_dir)._jdf.queryExecution().executedPlan().toString())
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024))
        large = summary(q(spark, sf_dir)._jdf.queryExecution().executedPlan().toString())
        rows.append((name, small, large))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    explain = [k for k in os.environ.get("EXPLAIN", "").split(",") if k]
    keys = list(PATTERNS)
    print(f"Physical operators per registered query ({os.path.basename(sf_dir)}; "
          "`a / b` = default broadcast threshold / 64 KB threshold, i.e. only fixed-size dimensions "
          "broadcast, as at 100 TB). Generated by `tools/plan_report.py`.\n")
    print("| query | " + " | ".join(keys) + " |")
    print("|---|" + "---|" * len(keys))
    for name, s, b in rows:
        cells = [str(s[k]) if s[k] == b[k] else f"{s[k]} / {b[k]}" for k in keys]
        print(f"| {name} | " + " | ".join(cells) + " |")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024))
    for name in explain:
        plan = qs[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        plan = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\], ", "", plan)
        plan = re.sub(r"#\d+L?", "", plan)
        print(f"\n### {name} (64 KB threshold: the shape at scale)\n\n```\n{plan.strip()}\n```")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))


if __name__ == "__main__":
    main()
