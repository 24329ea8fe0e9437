"""Quality report: one pass vs one Spark action per check (same engine, same data).

Usage: python tools/report_actions_bench.py [sf_dir]   -> one JSON line

"per-check actions" issues the checks the way a loop of separate counts does:
row count, a null count per column, total and distinct-key counts, a non-positive
count per column (11 actions for the typed order report; 2 + N for the generic
report). "one pass" is this library's report: one aggregate, one action.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from ledgerlake.entities import ORDERS  # noqa: E402
from ledgerlake.operators import quality as Q  # noqa: E402
from ledgerlake.session import local_session  # noqa: E402
from ledgerlake.sources import tables as V  # noqa: E402


def per_check_order_report(df) -> int:
    actions = 0
    df.count(); actions += 1  # noqa: E702
    for c in ORDERS.columns:
        df.filter(F.col(c).isNull()).count(); actions += 1  # noqa: E702
    df.count(); df.select(*ORDERS.key).distinct().count(); actions += 2  # noqa: E702
    for c in ORDERS.positive:
        df.filter(F.col(c) <= 0).count(); actions += 1  # noqa: E702
    return actions


def per_check_generic_report(df) -> int:
    actions = 0
    df.count(); df.dropDuplicates().count(); actions += 2  # noqa: E702
    for c in df.columns:
        df.filter(F.col(c).isNull()).count(); actions += 1  # noqa: E702
    return actions


def best(fn, repeat=3):
    t = None
    out = None
    for _ in range(repeat):
        t0 = time.perf_counter()
        out = fn()
        d = time.perf_counter() - t0
        t = d if t is None else min(t, d)
    return round(t, 3), out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    orders, customers = V.orders_dirty_view(spark, sf_dir), V.customers_dirty_view(spark, sf_dir)
    res = {}
    res["order_report_one_pass"], _ = best(lambda: Q.generate_order_quality_report(orders).collect())
    res["order_report_per_check"], n1 = best(lambda: per_check_order_report(orders))
    res["generic_report_one_pass"], _ = best(lambda: Q.generate_quality_report(customers, "c").collect())
    res["generic_report_per_check"], n2 = best(lambda: per_check_generic_report(customers))
    res["actions_per_check"] = {"order_report": n1, "generic_report": n2}
    print(json.dumps({"sf_dir": sf_dir, **res}))


if __name__ == "__main__":
    main()
