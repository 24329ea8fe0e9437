"""Z-order prunes files by either column; buckets join without a shuffle."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import analytics as A
from ledgerlake.sinks import layout as L
from ledgerlake.sinks import warehouse as W

SF = "/root/testdata/sf0.001"


def grid(spark, n=40_000):
    """Two independent columns, numbers and text."""
    return spark.range(n).select((F.pmod(F.xxhash64("id"), F.lit(200))).alias("customer_id"),
                                 F.concat(F.lit("p"), F.format_string("%03d", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(200))))
                                 .alias("product_id"), F.col("id").alias("v"))


def files_read(spark, location, column, value):
    """Files that a filter on a column's value cannot skip, by their minimum and maximum."""
    files = spark.read.parquet(location).groupBy(F.input_file_name().alias("f")).agg(
        F.min(column).alias("low"), F.max(column).alias("high"))
    return files.filter((F.col("low") <= F.lit(value)) & (F.col("high") >= F.lit(value))).count(), files.count()


def test_a_filter_on_either_column_prunes(spark, tmp_path):
    df, loc = grid(spark), {}
    for name, z in (("z_linear", False), ("z_inter", True)):
        loc[z] = W.load_table(spark, df, name, str(tmp_path / name), num_files=16, z_order=z)["location"]
        assert W.read_table(spark, name).count() == 40_000
    first, files = files_read(spark, loc[False], "customer_id", 77)
    second, _ = files_read(spark, loc[False], "product_id", "p077")
    assert first <= 2 and second == files == 16  # by order: only the first column prunes
    first, files = files_read(spark, loc[True], "customer_id", 77)
    second, _ = files_read(spark, loc[True], "product_id", "p077")
    assert first <= 8 and second <= 8 and files == 16


def test_the_layout_is_kept_on_reload(spark, tmp_path):
    W.load_table(spark, grid(spark, 4000), "z_kept", str(tmp_path), num_files=4, z_order=True)
    again = W.load_table(spark, grid(spark, 8000), "z_kept", str(tmp_path), num_files=16)
    assert W.z_ordered_table(spark, "z_kept") and again["rows_loaded"] == 8000
    assert files_read(spark, again["location"], "product_id", "p077")[0] < 12  # by order it is all 16


def test_a_hot_key_is_cut(spark):
    df = grid(spark, 20_000).withColumn("customer_id", F.when(F.col("v") % 3 == 0, 5).otherwise(F.col("customer_id")))
    df = df.withColumn("product_id", F.when(F.col("v") % 3 == 0, F.lit("p005")).otherwise(F.col("product_id")))
    out = L.z_ordered(df, ["customer_id", "product_id"], 8)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 0.25 * 20_000


def test_interleaved_bits_and_nulls(spark):
    bounds = {"a": [1, 2, 3], "b": [1, 2, 3]}
    rows = spark.createDataFrame([(a, b) for a in (0, 1, 2, 3, None) for b in (0, 1, 2, 3)], "a int, b int").select(
        "a", "b", L.z_key(["a", "b"], bounds, bits=2).alias("z")).collect()

    def want(a, b):
        a = a or 0
        return (a >> 1) << 3 | (b >> 1) << 2 | (a & 1) << 1 | b & 1
    assert [r["z"] for r in rows] == [want(r["a"], r["b"]) for r in rows]
    empty = spark.createDataFrame([], "a int, b string")
    assert L.quantile_bounds(empty, ["a", "b"]) == {"a": [], "b": []} and L.z_ordered(empty, ["a", "b"], 2).count() == 0


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_exchange_under_the_join(spark, tmp_path, no_broadcast):
    from ledgerlake.sources import tables as V
    customers, orders = V.customers_view(spark, SF), V.orders_view(spark, SF)
    want = sorted(map(repr, map(tuple, A.customer_analytics(customers, orders).collect())))
    for name, df in (("b_customers", customers), ("b_orders", orders)):
        done = L.load_bucketed(spark, df, name, str(tmp_path / name), ["customer_id"], 4)
        assert done["hottest_share"] < 0.1
    found = A.customer_analytics(spark.table("b_customers"), spark.table("b_orders"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    under = plan[plan.index("Join"):]
    assert re.search(r"(SortMerge|ShuffledHash)Join", plan) and "Exchange" not in under and "Bucketed: true" in under
    assert sorted(map(repr, map(tuple, found.collect()))) == want
    L.load_bucketed(spark, orders.limit(10), "b_orders", str(tmp_path / "b_orders"), ["customer_id"], 4, most=4)
    assert spark.table("b_orders").count() == 10


def test_a_hot_key_is_refused(spark, tmp_path):
    df = spark.range(900).selectExpr("IF(id % 3 = 0, 1, id) AS customer_id")
    with pytest.raises(ValueError, match="33% of the rows"):
        L.load_bucketed(spark, df, "b_hot", str(tmp_path), ["customer_id"], 8)
    assert not spark.catalog.tableExists("b_hot")
