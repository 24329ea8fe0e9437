from __future__ import annotations

import datetime as dt

from ledgerlake.operators import analytics as A


def test_dashboard_summary_typed(typed_tables):
    r = A.dashboard_summary(typed_tables["customers"], typed_tables["orders"], typed_tables["products"]).collect()[0]
    assert (r.total_customers, r.total_orders, r.total_products) == (14, 10, 5)
    assert r.total_units_sold == 23
    assert r.total_revenue == 1411.75
    assert r.average_order_value == 141.18


def test_business_summary_uncleaned(raw_tables, typed_tables):
    from ledgerlake.entities import ORDERS
    from ledgerlake.operators.cleaning import cast_to_entity
    r = A.business_summary(typed_tables["customers"], cast_to_entity(raw_tables["orders"], ORDERS)).collect()[0]
    assert (r.total_units_sold, r.total_revenue, r.average_order_value) == (24, 1090.75, 90.9)


def test_summary_on_empty_orders(spark, typed_tables):
    empty = typed_tables["orders"].limit(0)
    b = A.business_summary(typed_tables["customers"], empty).collect()[0]
    assert b.total_orders == 0 and b.total_revenue is None and b.average_order_value is None
    d = A.dashboard_summary(typed_tables["customers"], empty, typed_tables["products"]).collect()[0]
    assert (d.total_units_sold, d.total_revenue, d.average_order_value) == (0, 0.0, 0.0)


def test_revenue_by_product(typed_tables):
    rows = A.revenue_by_product(typed_tables["products"], typed_tables["orders"]).collect()
    assert [(r.product_name, r.total_revenue) for r in rows] == [
        ("Desk", 620.0), ("Lamp", 361.5), ("Kettle", 240.0), ("Notebook", 122.0), ("Pencil", 68.25)]


def test_product_analytics(typed_tables):
    rows = {r.product_name: r for r in A.product_analytics(typed_tables["products"], typed_tables["orders"]).collect()}
    assert (rows["Notebook"].total_orders, rows["Notebook"].total_units_sold) == (2, 8)
    assert rows["Pencil"].total_revenue == 68.25


def test_revenue_by_customer_left_join(typed_tables):
    rows = A.revenue_by_customer(typed_tables["customers"], typed_tables["orders"]).collect()
    got = {r.customer_id: r.total_revenue for r in rows}
    assert len(rows) == 14
    assert got[301] == 241.0 and got[306] == 39.0 and got[310] == 29.25
    for c in (311, 312, 313, 314):
        assert got[c] == 0.0
    assert rows[0].customer_id == 304


def test_customer_analytics_zero_defaults(typed_tables):
    rows = {r.customer_id: r for r in A.customer_analytics(typed_tables["customers"], typed_tables["orders"]).collect()}
    assert rows[313].total_orders == 0 and rows[313].total_items_purchased == 0
    assert rows[313].total_spend == 0.0 and rows[313].average_order_value == 0.0
    assert rows[308].total_items_purchased == 5


def test_duplicate_dimension_rows_fan_out(spark):
    cust = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "customer_id long, name string")
    orders = spark.createDataFrame([(10, 1, 7, 2, 1.5)],
                                   "order_id long, customer_id long, product_id long, quantity int, price double")
    orders = orders.selectExpr("*", "CAST(price AS DECIMAL(12,2)) AS p").drop("price").withColumnRenamed("p", "price")
    got = {r.customer_id: r.total_revenue for r in A.revenue_by_customer(cust, orders).collect()}
    assert got == {1: 6.0, 2: 0.0}  # the doubled customer row doubles the sum, as in SQL


def test_sales_analytics_and_share(typed_tables):
    rows = A.sales_analytics(typed_tables["orders"]).collect()
    assert rows[0].order_date == dt.date(2024, 5, 1)
    assert rows[0].total_revenue == 241.0 and rows[0].average_order_value == 241.0
    share = {r.product_name: r.pct_of_max for r in
             A.share_of_max(A.revenue_by_product(typed_tables["products"], typed_tables["orders"])).collect()}
    assert share["Desk"] == 100.0 and share["Pencil"] == 68.25 / 620 * 100


def test_first_orders(typed_tables):
    rows = A.first_orders(typed_tables["orders"], 5).collect()
    assert [r.order_id for r in rows] == [701, 702, 703, 704, 705]


def test_half_up_rounding_of_mean(spark):
    # 1.005 exactly: the mean of 1.00 and 1.01 -> rounds half up to 1.01
    orders = spark.createDataFrame([(1, 1, 1, dt.date(2025, 1, 1), 1, "1.00"), (2, 1, 1, dt.date(2025, 1, 1), 1, "1.01")],
                                   "order_id long, customer_id long, product_id long, order_date date, quantity int, "
                                   "price string").selectExpr("* EXCEPT (price)", "CAST(price AS DECIMAL(12,2)) AS price")
    r = A.sales_analytics(orders).collect()[0]
    assert r.average_order_value == 1.01 and r.total_revenue == 2.01


def test_labels(typed_tables):
    r = A.with_labels(A.revenue_over_time(typed_tables["orders"])).collect()[0]
    assert (r.date_label, r.amount_label) == ("05-01", "241.00")
    p = A.with_labels(A.revenue_by_product(typed_tables["products"], typed_tables["orders"]), date=None).collect()[0]
    assert p.amount_label == "620.00" and "date_label" not in p.asDict()


def test_analytics_views(spark, typed_tables):
    names = A.create_analytics_views(typed_tables["customers"], typed_tables["orders"], typed_tables["products"])
    assert set(names) == {"business_summary", "customer_analytics", "sales_analytics", "product_analytics"}
    assert spark.sql("SELECT total_orders FROM business_summary").collect()[0][0] == 10
    assert spark.sql("SELECT count(*) FROM customer_analytics").collect()[0][0] == 14


def test_mean_rounding_to_zero_is_positive_zero(spark):
    import math
    orders = spark.createDataFrame([(1, 1, 1, dt.date(2025, 1, 1), 1, "-0.01"), (2, 1, 1, dt.date(2025, 1, 1), 1, "0.00"),
                                    (3, 1, 1, dt.date(2025, 1, 1), 1, "0.00")],
                                   "order_id long, customer_id long, product_id long, order_date date, quantity int, "
                                   "price string").selectExpr("* EXCEPT (price)", "CAST(price AS DECIMAL(12,2)) AS price")
    r = A.sales_analytics(orders).collect()[0]
    assert r.average_order_value == 0.0 and math.copysign(1.0, r.average_order_value) == 1.0
    assert r.total_revenue == -0.01
