"""Hot keys: one customer / product holding a large share of all rows."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ledgerlake.operators import analytics as A
from ledgerlake.operators import cleaning as C
from ledgerlake.operators import quality as Q


def _orders(spark, n=20000):
    # customer 1 and product 7 hold half of all order lines
    return spark.range(n).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id") % 97 + 2).cast("long").alias("customer_id"),
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 13 + 8).cast("long").alias("product_id"),
        F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 30).cast("int")).alias("order_date"),
        (F.col("id") % 5 + 1).cast("int").alias("quantity"),
        ((F.col("id") % 1000) / 100 + 1).cast("decimal(12,2)").alias("price"),
    ).repartition(8)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _partial_below_shuffle(plan: str, key: str) -> bool:
    """The exchange on ``key`` sits directly on a partial aggregate."""
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if re.search(rf"Exchange hashpartitioning\({key}#", line):
            below = next((x for x in lines[i + 1:] if "Aggregate" in x or "Exchange" in x), "")
            if "partial_" in below:
                return True
    return False


def test_customer_totals_pre_aggregated(spark):
    orders = _orders(spark)
    customers = spark.range(1, 100).select(F.col("id").alias("customer_id"), F.lit("n").alias("name"))
    df = A.revenue_by_customer(customers, orders)
    assert _partial_below_shuffle(_plan(df), "customer_id")
    got = {r.customer_id: r.total_revenue for r in df.collect()}
    rows = orders.select("customer_id", (F.col("quantity") * F.col("price")).alias("a")).collect()
    expect = {}
    for r in rows:
        expect[r.customer_id] = expect.get(r.customer_id, 0) + r.a
    for c in range(1, 100):
        assert got[c] == float(expect.get(c, 0))


def test_hot_key_dedupe_and_reports_aggregate_map_side(spark):
    orders = _orders(spark)
    dedup = C.dedupe_by_key(orders, ["customer_id"])
    assert "partial_min" in _plan(dedup)
    assert dedup.count() == orders.select("customer_id").distinct().count()
    rep = Q.check_duplicates(orders, ["customer_id"], "orders")
    plan = _plan(rep)
    assert re.search(r"HashAggregate\(keys=\[[^\]]*customer_id", plan)  # distinct keys reduced map-side
    d = Q.report_as_dict(rep)["duplicates"]
    assert d["unique_rows"] == 98 and d["total_rows"] == 20000


def test_hot_product_share(spark):
    orders = _orders(spark)
    products = spark.range(7, 21).select(F.col("id").alias("product_id"),
                                         F.concat(F.lit("p"), F.col("id")).alias("product_name"))
    rows = {r.product_name: r.pct_of_max for r in A.share_of_max(A.revenue_by_product(products, orders)).collect()}
    assert rows["p7"] == 100.0 and all(v < 100.0 for k, v in rows.items() if k != "p7")


def test_hot_order_key_split_by_aqe_skew_join(spark, tmp_path):
    from ledgerlake.sources import tables as V
    d = str(tmp_path / "skewed")
    n = 40000
    # lineitem-like facts: order 0 holds half of all lines; orders: one row per order
    spark.range(n).select(
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).cast("long").alias("l_orderkey"),
        (F.col("id") % 50).alias("l_partkey"), F.lit(1).cast("long").alias("l_suppkey"),
        (F.col("id") % 7).cast("int").alias("l_linenumber"), F.lit(2.0).alias("l_quantity"),
        F.lit(10.5).alias("l_extendedprice"),
    ).repartition(8).write.parquet(f"{d}/lineitem.parquet")
    spark.range(n).select(F.col("id").alias("o_orderkey"), (F.col("id") % 100).alias("o_custkey"),
                          F.lit("2025-01-01").cast("timestamp_ntz").alias("o_orderdate")
                          ).repartition(8).write.parquet(f"{d}/orders.parquet")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = V.orders_view(spark, d)
        assert df.count() == n
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan  # hot key split
        # also where an aggregate on the same key follows, which would reuse the join's partitioning
        for keyed in (C.dedupe_by_key(df, ["order_id", "line_no"]), C.clean_orders(df), C.clean_orders(df, ["order_id", "line_no"])):
            keyed.collect()
            assert "SortMergeJoin(skew=true)" in keyed._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
