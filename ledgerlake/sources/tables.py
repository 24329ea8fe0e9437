"""Warehouse-style parquet tables and the entity views mapped onto them.

The given star-schema tables (customer, nation, region, part, orders, lineitem)
are mapped onto the library's three entities: customers, products and orders,
plus deterministic "dirty" variants that inject the defects the cleaners and
checks are for (spaces, blank and missing e-mails, copies, bad dates, non-positive
and missing quantities, negative prices). Every view keeps all input rows; defects
are injected by rules on the keys, never by sampling.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIGNUP_EPOCH = dt.date(2020, 1, 1)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of the given directory, listed anew by each call, so files that were added are read."""
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def customers_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer ⋈ nation ⋈ region as the customers entity.

    nation and region are fixed-size dimensions; Catalyst's size estimate from the
    parquet footers broadcasts them, the customer side is never shuffled.
    """
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("country"),
            F.date_add(F.lit(SIGNUP_EPOCH), (F.col("c_custkey") % 1000).cast("int")).alias("signup_date"),
        )
    )


def products_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as the products entity."""
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
    )


def orders_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders as the orders entity, one row per order line.

    A sort-merge (or AQE shuffled-hash) join on the order key: both sides grow
    with the data, so neither is broadcast unless AQE measures it small.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("price"),
    )


def orders_dirty_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders_view with text dates, some unparsable, and bad quantities and prices."""
    o = orders_view(spark, sf_dir)
    return o.select(
        "order_id", "line_no", "customer_id", "product_id",
        F.when(F.col("order_id") % 89 == 0, F.lit("not-a-date"))
        .otherwise(F.col("order_date").cast("string")).alias("order_date"),
        F.when(F.col("product_id") % 97 == 0, -F.col("quantity"))
        .when(F.col("product_id") % 101 == 0, F.lit(None).cast("int"))
        .otherwise(F.col("quantity")).alias("quantity"),
        F.when(F.col("customer_id") % 31 == 0, -F.col("price")).otherwise(F.col("price")).alias("price"),
    )


def customers_base_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers_view with padded names, missing / blank / shouting e-mails, text dates."""
    c = customers_view(spark, sf_dir)
    key = F.col("customer_id")
    return c.select(
        "customer_id",
        F.when(key % 5 == 0, F.concat(F.lit("  "), F.col("name"), F.lit(" "))).otherwise(F.col("name")).alias("name"),
        F.when(key % 11 == 0, F.lit(None).cast("string"))
        .when(key % 13 == 0, F.lit("   "))
        .when(key % 7 == 0, F.concat(F.lit(" "), F.upper(F.col("email")), F.lit(" ")))
        .otherwise(F.col("email")).alias("email"),
        "city", "country",
        F.col("signup_date").cast("string").alias("signup_date"),
    )


def customers_dirty_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers_base_view plus exact copies (key % 10 = 0) and copies equal only
    after trimming (key % 17 = 0).

    One scan: each row is exploded into itself and its copies instead of a union
    of three scans of the same source.
    """
    base = customers_base_view(spark, sf_dir)
    key = F.col("customer_id")
    copy = F.explode(F.array_compact(F.array(
        F.lit(0), F.when(key % 10 == 0, F.lit(1)), F.when(key % 17 == 0, F.lit(2)))))
    return base.select("*", copy.alias("_copy")).select(
        "customer_id",
        F.when(F.col("_copy") == 2, F.concat(F.lit(" "), F.col("name"))).otherwise(F.col("name")).alias("name"),
        "email", "city", "country", "signup_date",
    )


def products_dirty_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """products_view with padded names (key % 3 = 0) and categories (key % 4 = 0), every key % 10 = 0 twice, the
    second time under another name. One scan, as in :func:`customers_dirty_view`."""
    p = products_view(spark, sf_dir)
    key = F.col("product_id")
    copy = F.explode(F.array_compact(F.array(F.lit(0), F.when(key % 10 == 0, F.lit(1))))).alias("_copy")
    name = F.when(key % 3 == 0, F.concat(F.lit(" "), F.col("product_name"), F.lit("  "))).otherwise(F.col("product_name"))
    return p.select("*", copy).select(
        "product_id",
        F.when(F.col("_copy") == 1, F.concat(F.lit("zz "), F.col("product_name"))).otherwise(name).alias("product_name"),
        F.when(key % 4 == 0, F.concat(F.col("category"), F.lit(" "))).otherwise(F.col("category")).alias("category"))


VIEWS = {
    "customers_v": customers_view,
    "products_v": products_view,
    "orders_v": orders_view,
    "orders_dirty_v": orders_dirty_view,
    "customers_base_v": customers_base_view,
    "customers_dirty_v": customers_dirty_view,
    "products_dirty_v": products_dirty_view,
}


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Register every entity view as a temp view of the same name (for SQL users)."""
    for name, build in VIEWS.items():
        build(spark, sf_dir).createOrReplaceTempView(name)
