"""Business analytics over the customers / products / orders entities.

Plan shape used throughout:

* order lines are aggregated per join key first (partial + final hash aggregate),
  so only one row per key crosses the shuffle and a hot key (one customer with a
  third of all orders) collapses map-side instead of landing in one task;
* the dimension is left-joined to those totals (AQE picks broadcast only when it
  measures a side small, otherwise a shuffled join on the key);
* rows are regrouped by the reported dimension columns, which reproduces SQL's
  join-then-group result exactly, including fan-out from duplicated dimension rows.
  The join output is already hash-partitioned on the key, so this regroup adds no
  shuffle when the key is among the grouping columns;
* one-row summaries are a single aggregate per table combined through scalar
  subqueries, never a cross join or an unpartitioned window.

Money columns are exact (see :mod:`ledgerlake.functions.money`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.entities import CUSTOMERS, PRODUCTS
from ledgerlake.functions.money import line_amount, mean, money, rounded_mean

_ORDER_COLS = ("order_id", "customer_id", "product_id", "quantity", "price")


def order_totals(orders: DataFrame, *keys: str) -> DataFrame:
    """Per-key partial totals of order lines.

    ``_orders`` = COUNT(order_id), ``_units`` = SUM(quantity), ``_spend`` = exact
    SUM(quantity * price), ``_priced`` = COUNT(quantity * price) (the AVG divisor).
    """
    amount = line_amount()
    return orders.groupBy(*keys).agg(
        F.count("order_id").alias("_orders"),
        F.sum("quantity").alias("_units"),
        F.sum(amount).alias("_spend"),
        F.count(amount).alias("_priced"),
    )


def _dimension_totals(dim: DataFrame, dim_cols: list[str], orders: DataFrame, key: str,
                      group_cols: list[str]) -> DataFrame:
    """dim ⟕ orders on ``key``, grouped by ``group_cols``, with regrouped partial totals."""
    totals = order_totals(orders.select(*_ORDER_COLS), key)
    joined = dim.select(*dim_cols).join(totals, key, "left")
    return joined.groupBy(*group_cols).agg(
        F.coalesce(F.sum("_orders"), F.lit(0)).alias("_orders"),
        F.coalesce(F.sum("_units"), F.lit(0)).alias("_units"),
        F.sum("_spend").alias("_spend"),
        F.coalesce(F.sum("_priced"), F.lit(0)).alias("_priced"),
    )


def sales_analytics(orders: DataFrame) -> DataFrame:
    """Per order_date: total_orders, total_units_sold, total_revenue and
    average_order_value (both rounded to cents), ordered by order_date."""
    totals = order_totals(orders.select("order_date", *_ORDER_COLS), "order_date")
    return totals.select(
        "order_date",
        F.col("_orders").alias("total_orders"),
        F.col("_units").alias("total_units_sold"),
        money("_spend").alias("total_revenue"),
        rounded_mean("_spend", "_priced").alias("average_order_value"),
    ).orderBy("order_date")


def revenue_over_time(orders: DataFrame) -> DataFrame:
    """order_date, total_revenue (rounded), ordered by order_date."""
    amount = line_amount()
    return (
        orders.groupBy("order_date")
        .agg(money(F.sum(amount)).alias("total_revenue"))
        .orderBy("order_date")
    )


def _order_summary(orders: DataFrame) -> DataFrame:
    amount = line_amount()
    return orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("quantity").alias("total_units_sold"),
        F.sum(amount).alias("_spend"),
        F.count(amount).alias("_priced"),
    )


def _row_count(df: DataFrame) -> F.Column:
    """COUNT(*) of ``df`` as a scalar subquery column."""
    return df.select(F.count(F.lit(1))).scalar()


def business_summary(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row: total_customers, total_orders, total_units_sold, total_revenue and
    average_order_value (rounded). Sums are NULL when there are no orders.

    Orders are scanned once; customers are counted in a scalar subquery.
    """
    return _order_summary(orders).select(
        _row_count(customers).alias("total_customers"),
        "total_orders",
        "total_units_sold",
        money("_spend").alias("total_revenue"),
        rounded_mean("_spend", "_priced").alias("average_order_value"),
    )


def dashboard_summary(customers: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """business_summary plus total_products, with 0 instead of NULL on empty orders."""
    return _order_summary(orders).select(
        _row_count(customers).alias("total_customers"),
        "total_orders",
        _row_count(products).alias("total_products"),
        F.coalesce(F.col("total_units_sold"), F.lit(0).cast("long")).alias("total_units_sold"),
        F.coalesce(money("_spend"), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(rounded_mean("_spend", "_priced"), F.lit(0.0)).alias("average_order_value"),
    )


def customer_analytics(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Every customer (also those without orders) with total_orders,
    total_items_purchased, total_spend and unrounded average_order_value (0 if none)."""
    cols = list(CUSTOMERS.columns)
    g = _dimension_totals(customers, cols, orders, "customer_id", cols)
    return g.select(
        *cols,
        F.col("_orders").alias("total_orders"),
        F.col("_units").alias("total_items_purchased"),
        F.coalesce(money("_spend"), F.lit(0.0)).alias("total_spend"),
        F.coalesce(mean("_spend", "_priced"), F.lit(0.0)).alias("average_order_value"),
    )


def product_analytics(products: DataFrame, orders: DataFrame) -> DataFrame:
    """Every product with total_orders, total_units_sold, total_revenue and unrounded
    average_order_value (0 if none)."""
    cols = list(PRODUCTS.columns)
    g = _dimension_totals(products, cols, orders, "product_id", cols)
    return g.select(
        *cols,
        F.col("_orders").alias("total_orders"),
        F.col("_units").alias("total_units_sold"),
        F.coalesce(money("_spend"), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(mean("_spend", "_priced"), F.lit(0.0)).alias("average_order_value"),
    )


def revenue_by_product(products: DataFrame, orders: DataFrame) -> DataFrame:
    """product_name, total_revenue (rounded, 0 if none); products sharing a name are
    merged. Ordered by revenue descending, then name."""
    g = _dimension_totals(products, ["product_id", "product_name"], orders, "product_id", ["product_name"])
    return g.select(
        "product_name",
        F.coalesce(money("_spend"), F.lit(0.0)).alias("total_revenue"),
    ).orderBy(F.desc("total_revenue"), "product_name")


def revenue_by_customer(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """customer_id, customer_name, total_revenue (rounded, 0 if none), ordered by
    revenue descending, then customer_id."""
    g = _dimension_totals(customers, ["customer_id", "name"], orders, "customer_id", ["customer_id", "name"])
    return g.select(
        "customer_id",
        F.col("name").alias("customer_name"),
        F.coalesce(money("_spend"), F.lit(0.0)).alias("total_revenue"),
    ).orderBy(F.desc("total_revenue"), "customer_id")


def share_of_max(df: DataFrame, value: str = "total_revenue", out: str = "pct_of_max") -> DataFrame:
    """Add ``value / max(value) * 100`` (0 when the maximum is <= 0 or missing).

    The maximum is a scalar subquery (one partial/final aggregate), not a window
    over all rows, which would pull every row into a single task.
    """
    positive_top = df.select(F.when(F.max(value) > 0, F.max(value))).scalar()  # NULL unless > 0
    return df.select(
        "*",
        F.coalesce(F.col(value) / positive_top * F.lit(100), F.lit(0.0)).alias(out),
    )


def first_orders(orders: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` oldest orders (six order columns). Ties are broken by the other
    columns so the result is deterministic; plans as a top-k, not a full sort."""
    cols = ["order_id", "customer_id", "product_id", "order_date", "quantity", "price"]
    return orders.select(*cols).orderBy(
        F.col("order_date").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in cols if c != "order_date"]
    ).limit(n)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, total_rows for each named DataFrame (one small aggregate each)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("total_rows")).select(F.lit(name).alias("table_name"), "total_rows")
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def with_labels(df: DataFrame, date: str | None = "order_date", amount: str = "total_revenue") -> DataFrame:
    """Presentation columns used by the dashboard: ``date_label`` (MM-dd of the ISO
    date) and ``amount_label`` (thousands separators, two decimals)."""
    cols = [F.col("*")]
    if date and date in df.columns:
        cols.append(F.date_format(date, "MM-dd").alias("date_label"))
    cols.append(F.format_number(F.col(amount), 2).alias("amount_label"))
    return df.select(*cols)


def create_analytics_views(customers: DataFrame, orders: DataFrame, products: DataFrame) -> list[str]:
    """Register the four warehouse views (``CREATE OR REPLACE VIEW``) as temporary
    views: business_summary, customer_analytics, sales_analytics, product_analytics."""
    views = {
        "business_summary": business_summary(customers, orders),
        "customer_analytics": customer_analytics(customers, orders),
        "sales_analytics": sales_analytics(orders),
        "product_analytics": product_analytics(products, orders),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
