"""

Usage: python tools/scale_copy.py SRC_DIR DST_DIR [k=10] [files=8]

Every customer, part, order and order line is repeated k times with its keys
shifted by a per-copy offset (relationships stay consistent; nation and region are
copied as they are). Large tables are written as ``files`` Parquet files each, so
scans run in parallel. DST_DIR must not exist yet (nothing is overwritten).
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from ledgerlake.session import local_session  # noqa: E402


def main() -> None:
    src, dst = sys.argv[1].rstrip("/"), sys.argv[2].rstrip("/")
    k = int(sys.argv[3]) if len(sys.argv) > 3 else 10
    files = int(sys.argv[4]) if len(sys.argv) > 4 else 8
    if os.path.exists(dst):
        raise SystemExit(f"{dst} exists")
    spark = local_session(8, 16)

    def read(t):
        return spark.read.parquet(f"{src}/{t}.parquet")

    offset = {t: read(t).agg(F.max(c)).first()[0] + 1
              for t, c in [("orders", "o_orderkey"), ("customer", "c_custkey"), ("part", "p_partkey")]}

    def scaled(t, shifts):
        copy = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_copy")
        df = read(t).select("*", copy)
        for col, base in shifts.items():
            df = df.withColumn(col, F.col(col) + F.col("_copy") * F.lit(offset[base]))
        return df.drop("_copy")

    tables = {
        "region": read("region"),
        "nation": read("nation"),
        "customer": scaled("customer", {"c_custkey": "customer"}),
        "part": scaled("part", {"p_partkey": "part"}),
        "orders": scaled("orders", {"o_orderkey": "orders", "o_custkey": "customer"}),
        "lineitem": scaled("lineitem", {"l_orderkey": "orders", "l_partkey": "part"}),
    }
    for t, df in tables.items():
        df.repartition(1 if t in ("region", "nation") else files).write.parquet(f"{dst}/{t}.parquet")
        print(t, spark.read.parquet(f"{dst}/{t}.parquet").count())


if __name__ == "__main__":
    main()
