"""The registered queries: each a Spark plan over the parquet tables plus its SQL twin.

Every query reads the whole given tables (through the entity views of
:mod:`ledgerlake.sources.tables`) so its work grows with them. Output columns are
named identically on both sides. The registered results are presented the same
way on both sides so they compare value for value however a checker converts
them: DECIMAL as DOUBLE, DATE as ISO ``yyyy-MM-dd`` text (engines hand dates to
pandas as different Python types). The library operators themselves return
DECIMAL and DATE.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.entities import CUSTOMERS, ORDERS, PRODUCTS
from ledgerlake.functions.columns import col as column
from ledgerlake.functions.naming import normalize_columns
from ledgerlake.operators import analytics as A
from ledgerlake.operators import cleaning as C
from ledgerlake.operators import profiles
from ledgerlake.operators import quality as Q
from ledgerlake.plans import oracle as O
from ledgerlake.plans import pipeline as P
from ledgerlake.session import ensure_checkpoint_dir
from ledgerlake.sinks import content, layout
from ledgerlake.sinks import warehouse as W
from ledgerlake.sinks.versions import current_version, load_version, version_table, versions
from ledgerlake.sources import csv_records, json_variant
from ledgerlake.sources import tables as V

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Presentation of a registered result: DECIMAL -> DOUBLE, DATE -> ISO text."""
    def present(f):
        c = column(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return c.cast("string").alias(f.name)
        return c
    return df.select(*[present(f) for f in df.schema.fields])


def _cust(s, d):
    return V.customers_view(s, d)


def _prod(s, d):
    return V.products_view(s, d)


def _ord(s, d):
    return V.orders_view(s, d)


# --- analytics ------------------------------------------------------------------

def q_sales_analytics(s, d):
    return A.sales_analytics(_ord(s, d))


def q_revenue_over_time(s, d):
    return A.revenue_over_time(_ord(s, d))


def q_business_summary(s, d):
    return A.business_summary(_cust(s, d), _ord(s, d))


def q_dashboard_summary(s, d):
    return A.dashboard_summary(_cust(s, d), _ord(s, d), _prod(s, d))


def q_customer_analytics(s, d):
    return A.customer_analytics(_cust(s, d), _ord(s, d))


def q_product_analytics(s, d):
    return A.product_analytics(_prod(s, d), _ord(s, d))


def q_revenue_by_product(s, d):
    return A.revenue_by_product(_prod(s, d), _ord(s, d))


def q_revenue_by_customer(s, d):
    return A.revenue_by_customer(_cust(s, d), _ord(s, d))


def q_revenue_by_product_share(s, d):
    return A.share_of_max(A.revenue_by_product(_prod(s, d), _ord(s, d)))


def q_first_orders(s, d):
    return A.first_orders(_ord(s, d), 5)


def q_table_counts(s, d):
    return A.table_counts({"customers": _cust(s, d), "orders": _ord(s, d), "products": _prod(s, d)})


M = O.money("SUM(o.quantity * o.price)")
AMT_SUM, AMT_N = "SUM(quantity * price)", "COUNT(quantity * price)"

ORACLE: dict[str, str] = {}

ORACLE["sales_analytics"] = O.with_views("orders_v") + f"""
SELECT order_date, COUNT(order_id) AS total_orders, CAST(SUM(quantity) AS BIGINT) AS total_units_sold,
       {O.money(AMT_SUM)} AS total_revenue, {O.rounded_mean(AMT_SUM, AMT_N)} AS average_order_value
FROM orders_v GROUP BY order_date ORDER BY order_date"""

ORACLE["revenue_over_time"] = O.with_views("orders_v") + f"""
SELECT order_date, {O.money(AMT_SUM)} AS total_revenue FROM orders_v GROUP BY order_date ORDER BY order_date"""

ORACLE["business_summary"] = O.with_views("customers_v", "orders_v") + f"""
SELECT (SELECT COUNT(*) FROM customers_v) AS total_customers,
       (SELECT COUNT(*) FROM orders_v) AS total_orders,
       (SELECT CAST(SUM(quantity) AS BIGINT) FROM orders_v) AS total_units_sold,
       (SELECT {O.money(AMT_SUM)} FROM orders_v) AS total_revenue,
       (SELECT {O.rounded_mean(AMT_SUM, AMT_N)} FROM orders_v) AS average_order_value"""

ORACLE["dashboard_summary"] = O.with_views("customers_v", "orders_v", "products_v") + f"""
SELECT (SELECT COUNT(*) FROM customers_v) AS total_customers,
       (SELECT COUNT(*) FROM orders_v) AS total_orders,
       (SELECT COUNT(*) FROM products_v) AS total_products,
       (SELECT CAST(COALESCE(SUM(quantity), 0) AS BIGINT) FROM orders_v) AS total_units_sold,
       (SELECT COALESCE({O.money(AMT_SUM)}, 0.0) FROM orders_v) AS total_revenue,
       (SELECT COALESCE({O.rounded_mean(AMT_SUM, AMT_N)}, 0.0) FROM orders_v) AS average_order_value"""

ORACLE["customer_analytics"] = O.with_views("customers_v", "orders_v") + f"""
SELECT c.customer_id, c.name, c.email, c.city, c.country, c.signup_date,
       COUNT(o.order_id) AS total_orders,
       CAST(COALESCE(SUM(o.quantity), 0) AS BIGINT) AS total_items_purchased,
       COALESCE({M}, 0.0) AS total_spend,
       COALESCE({O.mean("SUM(o.quantity * o.price)", "COUNT(o.quantity * o.price)")}, 0.0) AS average_order_value
FROM customers_v c LEFT JOIN orders_v o ON c.customer_id = o.customer_id
GROUP BY c.customer_id, c.name, c.email, c.city, c.country, c.signup_date"""

ORACLE["product_analytics"] = O.with_views("products_v", "orders_v") + f"""
SELECT p.product_id, p.product_name, p.category,
       COUNT(o.order_id) AS total_orders,
       CAST(COALESCE(SUM(o.quantity), 0) AS BIGINT) AS total_units_sold,
       COALESCE({M}, 0.0) AS total_revenue,
       COALESCE({O.mean("SUM(o.quantity * o.price)", "COUNT(o.quantity * o.price)")}, 0.0) AS average_order_value
FROM products_v p LEFT JOIN orders_v o ON p.product_id = o.product_id
GROUP BY p.product_id, p.product_name, p.category"""

_REV_BY_PRODUCT = f"""
SELECT p.product_name, COALESCE({M}, 0.0) AS total_revenue
FROM products_v p LEFT JOIN orders_v o ON p.product_id = o.product_id
GROUP BY p.product_name"""

ORACLE["revenue_by_product"] = O.with_views("products_v", "orders_v") + _REV_BY_PRODUCT + """
ORDER BY total_revenue DESC, product_name"""

ORACLE["revenue_by_customer"] = O.with_views("customers_v", "orders_v") + f"""
SELECT c.customer_id, c.name AS customer_name, COALESCE({M}, 0.0) AS total_revenue
FROM customers_v c LEFT JOIN orders_v o ON c.customer_id = o.customer_id
GROUP BY c.customer_id, c.name
ORDER BY total_revenue DESC, c.customer_id"""

ORACLE["revenue_by_product_share"] = O.with_views("products_v", "orders_v") + f"""
, r AS ({_REV_BY_PRODUCT})
SELECT product_name, total_revenue,
       CASE WHEN (SELECT MAX(total_revenue) FROM r) > 0
            THEN total_revenue / (SELECT MAX(total_revenue) FROM r) * 100 ELSE 0.0 END AS pct_of_max
FROM r"""

ORACLE["first_orders"] = O.with_views("orders_v") + """
SELECT order_id, customer_id, product_id, order_date, quantity, CAST(price AS DOUBLE) AS price
FROM orders_v
ORDER BY order_date NULLS FIRST, order_id NULLS FIRST, customer_id NULLS FIRST, product_id NULLS FIRST,
         quantity NULLS FIRST, price NULLS FIRST
LIMIT 5"""

ORACLE["table_counts"] = O.with_views("customers_v", "orders_v", "products_v") + """
SELECT 'customers' AS table_name, COUNT(*) AS total_rows FROM customers_v
UNION ALL SELECT 'orders', COUNT(*) FROM orders_v
UNION ALL SELECT 'products', COUNT(*) FROM products_v"""


QUERIES: dict[str, Query] = {
    "sales_analytics": q_sales_analytics,
    "revenue_over_time": q_revenue_over_time,
    "business_summary": q_business_summary,
    "dashboard_summary": q_dashboard_summary,
    "customer_analytics": q_customer_analytics,
    "product_analytics": q_product_analytics,
    "revenue_by_product": q_revenue_by_product,
    "revenue_by_customer": q_revenue_by_customer,
    "revenue_by_product_share": q_revenue_by_product_share,
    "first_orders": q_first_orders,
    "table_counts": q_table_counts,
}


# --- names and cleaning -----------------------------------------------------------

_MESSY_HEADERS = [  # (source column, raw header) -> normalised header in the oracle
    ("c_custkey", "Customer ID", "customer_id"),
    ("c_name", "Name", "name"),
    ("c_name", "name", "name_2"),
    ("c_acctbal", "Balance ($)", "balance"),
    ("c_mktsegment", "1st Segment", "column_1st_segment"),
    ("c_nationkey", "__", "column"),
    ("c_custkey", "x.y", "x_y"),
]


def q_normalize_columns(s, d):
    raw = V.read_table(s, d, "customer").select(*[F.col(src).alias(h) for src, h, _ in _MESSY_HEADERS])
    return normalize_columns(raw)


def _dirty_cust(s, d):
    return V.customers_dirty_view(s, d)


def _dirty_ord(s, d):
    return V.orders_dirty_view(s, d)


def _dirty_prod(s, d):
    return V.products_dirty_view(s, d)


ORDER_LINE_KEY = ["order_id", "line_no"]


def q_clean_strings(s, d):
    return C.clean_strings(_dirty_cust(s, d))


def q_drop_duplicate_rows(s, d):
    return C.drop_duplicate_rows(_dirty_cust(s, d))


def q_clean_customers(s, d):
    return C.clean_customers(_dirty_cust(s, d))


def q_clean_orders(s, d):
    return C.clean_orders(_dirty_ord(s, d), key=ORDER_LINE_KEY)


def q_clean_orders_by_order_id(s, d):
    return C.clean_orders(_dirty_ord(s, d))


def q_clean_products(s, d):
    return C.clean_products(_dirty_prod(s, d))


def q_dedupe_by_key(s, d):
    return C.dedupe_by_key(_ord(s, d), ORDER_LINE_KEY)


def q_dedupe_by_order_id(s, d):
    return C.dedupe_by_key(_ord(s, d), ["order_id"])


def q_reject_orders(s, d):
    return C.reject_orders(_dirty_ord(s, d))


ORACLE["normalize_columns"] = "SELECT " + ", ".join(
    f'{src} AS "{out}"' for src, _, out in _MESSY_HEADERS) + " FROM customer"

_TRIMMED_CUST = """SELECT customer_id, NULLIF(TRIM(name), '') AS name, NULLIF(TRIM(email), '') AS email,
       NULLIF(TRIM(city), '') AS city, NULLIF(TRIM(country), '') AS country,
       NULLIF(TRIM(signup_date), '') AS signup_date
FROM customers_dirty_v"""

ORACLE["clean_strings"] = O.with_views("customers_dirty_v") + _TRIMMED_CUST
ORACLE["drop_duplicate_rows"] = O.with_views("customers_dirty_v") + "SELECT DISTINCT * FROM customers_dirty_v"


def _first_per_key(source: str, keys: list[str], order: list[str]) -> str:
    """Rows ranked first per key (row_number form of the deterministic dedupe)."""
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY {', '.join(c + ' NULLS FIRST' for c in order)}) AS rn FROM {source}) WHERE rn = 1")


ORACLE["clean_customers"] = O.with_views("customers_dirty_v") + f"""
SELECT customer_id, TRIM(name) AS name, LOWER(TRIM(email)) AS email, TRIM(city) AS city, TRIM(country) AS country,
       TRY_CAST(signup_date AS DATE) AS signup_date
FROM ({_first_per_key("customers_dirty_v", ["customer_id"], ["name", "email", "city", "country", "signup_date"])})"""

_TYPED_DIRTY = """(SELECT order_id, line_no, customer_id, product_id, TRY_CAST(order_date AS DATE) AS order_date,
        quantity, price FROM orders_dirty_v WHERE quantity > 0 AND price > 0) t"""

ORACLE["clean_orders"] = O.with_views("orders_dirty_v") + f"""
SELECT order_id, line_no, customer_id, product_id, order_date, quantity, CAST(price AS DOUBLE) AS price
FROM ({_first_per_key(_TYPED_DIRTY, ORDER_LINE_KEY, ["customer_id", "product_id", "order_date", "quantity", "price"])})"""

_ORDER_REST = ["line_no", "customer_id", "product_id", "order_date", "quantity", "price"]

ORACLE["clean_orders_by_order_id"] = O.with_views("orders_dirty_v") + f"""
SELECT order_id, line_no, customer_id, product_id, order_date, quantity, CAST(price AS DOUBLE) AS price
FROM ({_first_per_key(_TYPED_DIRTY, ["order_id"], _ORDER_REST)})"""

ORACLE["dedupe_by_order_id"] = O.with_views("orders_v") + f"""
SELECT order_id, line_no, customer_id, product_id, order_date, quantity, CAST(price AS DOUBLE) AS price
FROM ({_first_per_key("orders_v", ["order_id"], _ORDER_REST)})"""

ORACLE["clean_products"] = O.with_views("products_dirty_v") + f"""
SELECT * FROM ({_first_per_key("(SELECT product_id, TRIM(product_name) AS product_name, TRIM(category) AS category "
                               "FROM products_dirty_v) t", ["product_id"], ["product_name", "category"])})"""

ORACLE["dedupe_by_key"] = O.with_views("orders_v") + f"""
SELECT order_id, line_no, customer_id, product_id, order_date, quantity, CAST(price AS DOUBLE) AS price
FROM ({_first_per_key("orders_v", ORDER_LINE_KEY, ["customer_id", "product_id", "order_date", "quantity", "price"])})"""

ORACLE["reject_orders"] = O.with_views("orders_dirty_v") + """
SELECT order_id, line_no, customer_id, product_id, order_date, quantity, CAST(price AS DOUBLE) AS price,
       concat_ws(',', CASE WHEN quantity IS NULL THEN 'quantity_missing' END,
                      CASE WHEN quantity <= 0 THEN 'quantity_not_positive' END,
                      CASE WHEN price IS NULL THEN 'price_missing' END,
                      CASE WHEN price <= 0 THEN 'price_not_positive' END) AS reject_reason
FROM orders_dirty_v WHERE NOT COALESCE(quantity > 0 AND price > 0, FALSE)"""


# --- quality reports ----------------------------------------------------------------

_DIRTY_CUST_COLS = list(CUSTOMERS.columns)
_DIRTY_ORD_COLS = ["order_id", "line_no", "customer_id", "product_id", "order_date", "quantity", "price"]


def _generic_report_sql(source: str, dataset: str, columns: list[str]) -> O.SqlReport:
    r = O.SqlReport(source, dataset)
    n = r.row_count()
    r.row("column_count", None, str(len(columns)), "TRUE")
    r.row("schema", None, str(len(columns)), "TRUE" if columns else "FALSE")
    r.nulls(columns, informational=True)
    r.duplicate_rows(columns, n)
    return r


def _entity_report_sql(source: str, spec, present: list[str], text_dates: list[str] = ()) -> O.SqlReport:
    r = O.SqlReport(source, spec.name)
    n = r.row_count()
    cols = r.required_columns(spec.columns, present)
    r.nulls(cols)
    keys = [k for k in spec.key if k in cols]
    if keys:
        r.duplicate_keys(keys, n)
    pos = [c for c in spec.positive if c in cols]
    if pos:
        r.positive(pos)
    if text_dates:
        r.unparsable_dates(list(text_dates))
    return r


def q_quality_report(s, d):
    return Q.generate_quality_report(_dirty_cust(s, d), "customers_dirty")


def q_customer_quality_report(s, d):
    return Q.generate_customer_quality_report(_dirty_cust(s, d))


def q_order_quality_report(s, d):
    return Q.generate_order_quality_report(_dirty_ord(s, d))


def q_product_quality_report(s, d):
    return Q.generate_product_quality_report(_dirty_prod(s, d))


def q_check_nulls(s, d):
    return Q.check_nulls(_dirty_ord(s, d), _DIRTY_ORD_COLS, "orders")


def q_check_duplicates(s, d):
    return Q.check_duplicates(_ord(s, d), ORDER_LINE_KEY, "orders")


def q_check_positive_values(s, d):
    return Q.check_positive_values(_dirty_ord(s, d), list(ORDERS.positive), "orders")


def q_check_required_columns(s, d):
    return Q.check_required_columns(_dirty_ord(s, d), list(ORDERS.columns), "orders")


def q_check_missing_columns(s, d):
    return Q.check_required_columns(_dirty_ord(s, d).drop("price", "quantity"), list(ORDERS.columns), "orders")


def q_quality_before_after(s, d):
    raw = _dirty_cust(s, d)
    return Q.quality_before_after(raw, C.clean_dataframe(raw), "customers_dirty")


ORACLE["quality_report"] = _generic_report_sql("customers_dirty_v", "customers_dirty", _DIRTY_CUST_COLS).sql(
    O.with_views("customers_dirty_v"))
ORACLE["customer_quality_report"] = _entity_report_sql("customers_dirty_v", CUSTOMERS, _DIRTY_CUST_COLS,
                                                       ["signup_date"]).sql(
    O.with_views("customers_dirty_v"))
ORACLE["order_quality_report"] = _entity_report_sql("orders_dirty_v", ORDERS, _DIRTY_ORD_COLS, ["order_date"]).sql(
    O.with_views("orders_dirty_v"))
ORACLE["product_quality_report"] = _entity_report_sql("products_dirty_v", PRODUCTS, list(PRODUCTS.columns)).sql(
    O.with_views("products_dirty_v"))

_r = O.SqlReport("orders_dirty_v", "orders")
_r.nulls(_DIRTY_ORD_COLS)
ORACLE["check_nulls"] = _r.sql(O.with_views("orders_dirty_v"))

_r = O.SqlReport("orders_v", "orders")
_n = _r.metric("COUNT(*)")
_r.row("total_rows", None, _n, "TRUE")
_r.duplicate_keys(ORDER_LINE_KEY, _n)
ORACLE["check_duplicates"] = _r.sql(O.with_views("orders_v"))

_r = O.SqlReport("orders_dirty_v", "orders")
_r.positive(list(ORDERS.positive))
ORACLE["check_positive_values"] = _r.sql(O.with_views("orders_dirty_v"))

_r = O.SqlReport("orders_dirty_v", "orders")
_r.row_count()
_r.required_columns(ORDERS.columns, _DIRTY_ORD_COLS)
ORACLE["check_required_columns"] = _r.sql(O.with_views("orders_dirty_v"))

_r = O.SqlReport("orders_dirty_v", "orders")
_r.row_count()
_r.required_columns(ORDERS.columns, [c for c in _DIRTY_ORD_COLS if c not in ("price", "quantity")])
ORACLE["check_missing_columns"] = _r.sql(O.with_views("orders_dirty_v"))

_before = _generic_report_sql("customers_dirty_v", "customers_dirty", _DIRTY_CUST_COLS).sql(
    O.with_views("customers_dirty_v"))
_after = _generic_report_sql(f"(SELECT DISTINCT * FROM ({_TRIMMED_CUST})) t0", "customers_dirty", _DIRTY_CUST_COLS)
ORACLE["quality_before_after"] = (
    f"SELECT 'raw' AS stage, * FROM ({_before})\nUNION ALL\n"
    f"SELECT 'processed' AS stage, * FROM ({_after.sql(O.with_views('customers_dirty_v'))})")

QUERIES.update({
    "normalize_columns": q_normalize_columns,
    "clean_strings": q_clean_strings,
    "drop_duplicate_rows": q_drop_duplicate_rows,
    "clean_customers": q_clean_customers,
    "clean_orders": q_clean_orders,
    "clean_orders_by_order_id": q_clean_orders_by_order_id,
    "clean_products": q_clean_products,
    "dedupe_by_key": q_dedupe_by_key,
    "dedupe_by_order_id": q_dedupe_by_order_id,
    "reject_orders": q_reject_orders,
    "quality_report": q_quality_report,
    "customer_quality_report": q_customer_quality_report,
    "order_quality_report": q_order_quality_report,
    "product_quality_report": q_product_quality_report,
    "check_nulls": q_check_nulls,
    "check_duplicates": q_check_duplicates,
    "check_positive_values": q_check_positive_values,
    "check_required_columns": q_check_required_columns,
    "check_missing_columns": q_check_missing_columns,
    "quality_before_after": q_quality_before_after,
})


# --- the typed path end to end: dirty input -> typed cleaners -> dashboard -----------

def _typed_inputs(s, d):
    return (C.clean_customers(_dirty_cust(s, d)),
            C.clean_orders(_dirty_ord(s, d), key=ORDER_LINE_KEY),
            C.clean_products(_prod(s, d)))


def q_typed_dashboard_summary(s, d):
    cust, orders, prod = _typed_inputs(s, d)
    return A.dashboard_summary(cust, orders, prod)


def q_typed_revenue_by_customer(s, d):
    cust, orders, _ = _typed_inputs(s, d)
    return A.revenue_by_customer(cust, orders)


def q_revenue_over_time_labels(s, d):
    return A.with_labels(A.revenue_over_time(_ord(s, d)))


_CLEAN_CTES = f""",
cc AS (SELECT customer_id, TRIM(name) AS name, LOWER(TRIM(email)) AS email, TRIM(city) AS city, TRIM(country) AS country,
       TRY_CAST(signup_date AS DATE) AS signup_date
FROM ({_first_per_key("customers_dirty_v", ["customer_id"], ["name", "email", "city", "country", "signup_date"])})),
co AS (SELECT * FROM ({_first_per_key(_TYPED_DIRTY, ORDER_LINE_KEY,
                                      ["customer_id", "product_id", "order_date", "quantity", "price"])})),
cp AS ({_first_per_key("(SELECT product_id, TRIM(product_name) AS product_name, TRIM(category) AS category "
                       "FROM products_v) t", ["product_id"], ["product_name", "category"])})
"""

ORACLE["typed_dashboard_summary"] = O.with_views("customers_dirty_v", "orders_dirty_v", "products_v") + \
    _CLEAN_CTES + f"""
SELECT (SELECT COUNT(*) FROM cc) AS total_customers,
       (SELECT COUNT(*) FROM co) AS total_orders,
       (SELECT COUNT(*) FROM cp) AS total_products,
       (SELECT CAST(COALESCE(SUM(quantity), 0) AS BIGINT) FROM co) AS total_units_sold,
       (SELECT COALESCE({O.money(AMT_SUM)}, 0.0) FROM co) AS total_revenue,
       (SELECT COALESCE({O.rounded_mean(AMT_SUM, AMT_N)}, 0.0) FROM co) AS average_order_value"""

ORACLE["typed_revenue_by_customer"] = O.with_views("customers_dirty_v", "orders_dirty_v", "products_v") + \
    _CLEAN_CTES + f"""
SELECT c.customer_id, c.name AS customer_name, COALESCE({M}, 0.0) AS total_revenue
FROM cc c LEFT JOIN co o ON c.customer_id = o.customer_id
GROUP BY c.customer_id, c.name
ORDER BY total_revenue DESC, c.customer_id"""

ORACLE["revenue_over_time_labels"] = O.with_views("orders_v") + f"""
SELECT order_date, total_revenue, strftime(order_date, '%m-%d') AS date_label,
       format('{{:,.2f}}', total_revenue) AS amount_label
FROM (SELECT order_date, {O.money(AMT_SUM)} AS total_revenue FROM orders_v GROUP BY order_date)
ORDER BY order_date"""

QUERIES.update({
    "typed_dashboard_summary": q_typed_dashboard_summary,
    "typed_revenue_by_customer": q_typed_revenue_by_customer,
    "revenue_over_time_labels": q_revenue_over_time_labels,
})


# --- the generic cleaner on raw headers (the transformation of a generic run) ---------------

_RAW_CUSTOMER_HEADERS = [  # view column -> raw header -> normalised name
    ("customer_id", "Customer ID", "customer_id"),
    ("name", "Full Name", "full_name"),
    ("email", "E-mail", "e_mail"),
    ("city", " City ", "city"),
    ("country", "Country", "country"),
    ("signup_date", "Signup Date (ISO)", "signup_date_iso"),
]


def q_clean_dataframe(s, d):
    raw = _dirty_cust(s, d).select(*[F.col(c).alias(h) for c, h, _ in _RAW_CUSTOMER_HEADERS])
    return C.clean_dataframe(raw)


ORACLE["clean_dataframe"] = O.with_views("customers_dirty_v") + "SELECT DISTINCT " + ", ".join(
    f'NULLIF(TRIM({c}), \'\') AS "{out}"' if c != "customer_id" else f'{c} AS "{out}"'
    for c, _, out in _RAW_CUSTOMER_HEADERS) + " FROM customers_dirty_v"

QUERIES["clean_dataframe"] = q_clean_dataframe


# --- a whole generic run, and the reconciliation of loaded tables ----------------------------

def _scratch(s, name):
    """A new folder for tables in the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(s).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_generic_pipeline(s, d):
    raw = _dirty_cust(s, d).select(*[F.col(c).alias(h) for c, h, _ in _RAW_CUSTOMER_HEADERS])
    table = f"customers_dirty_{uuid.uuid4().hex}"
    report = _held(P.generic_run_report(s, raw, f"{table}.csv", _scratch(s, "generic")))
    s.sql(f"DROP TABLE {table}")
    return report


def _held(report):
    """The rows of a report, which are as many as there are checks, without what they were made from."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)


def q_verify_tables(s, d):
    views, suffix = {"customers": _cust(s, d), "orders": _ord(s, d), "products": _prod(s, d)}, uuid.uuid4().hex
    root, expected = _scratch(s, "verify"), {}
    for name, df in views.items():
        expected[f"{name}_{suffix}"] = W.load_table(s, df, f"{name}_{suffix}", f"{root}/{name}")["rows_loaded"]
    found = _held(W.verify_tables(s, expected))
    for table in expected:
        s.sql(f"DROP TABLE {table}")
    return found.withColumn("table_name", F.substring_index("table_name", "_", 1))


def q_reconcile_tables(s, d):
    """Content and layout of loaded customers against what their load recorded: as loaded, and after changes below the
    catalog that keep the number of rows."""
    rows, found = _cust(s, d), []
    changed = rows.withColumn("city", F.when(F.col("customer_id") == 7, F.lit("elsewhere")).otherwise(F.col("city")))
    swapped = rows.withColumns({"city": F.col("country"), "country": F.col("city")})
    turned = rows.withColumn("customer_id", F.when(F.col("customer_id") == 7, 8).otherwise(F.col("customer_id")).cast("long"))
    for case, other in (("as loaded", None), ("changed value", changed), ("swapped columns", swapped),
                        ("lost and repeated row", turned)):
        table = f"customers_{uuid.uuid4().hex}"
        done = W.load_table(s, rows, table, f"{_scratch(s, 'reconcile')}/{table}", num_files=2)
        if other is not None:
            (other.withColumn(W.INGEST_DATE, F.current_date()).select(*s.table(table).columns)
             .write.mode("overwrite").partitionBy(W.INGEST_DATE).parquet(done["location"]))
            s.catalog.refreshTable(table)
        report = content.reconcile(s, [table]).withColumn("case", F.lit(case))
        found.append(_held(report.select("case", "check_name", "matches", F.when(
            F.col("check_name") == "row_count", F.col("actual").cast("long")).alias("table_rows"))))
        s.sql(f"DROP TABLE {table}")
    return reduce(DataFrame.unionByName, found)


_RAW_NAMES = [h for _, h, _ in _RAW_CUSTOMER_HEADERS]
_CLEAN_NAMES = [n for _, _, n in _RAW_CUSTOMER_HEADERS]
_RAW_SQL = "(SELECT " + ", ".join(f'{c} AS "{h}"' for c, h, _ in _RAW_CUSTOMER_HEADERS) + " FROM customers_dirty_v)"
_CLEAN_SQL = "(" + ORACLE["clean_dataframe"].removeprefix(O.with_views("customers_dirty_v")) + ")"
ORACLE["generic_pipeline"] = (
    "SELECT 'raw' AS stage, check_name, column_name, value, passed FROM ("
    + _generic_report_sql(f"{_RAW_SQL} t0", "raw", _RAW_NAMES).sql(O.with_views("customers_dirty_v"))
    + ")\nUNION ALL\nSELECT 'processed', check_name, column_name, value, passed FROM ("
    + _generic_report_sql(f"{_CLEAN_SQL} t0", "processed", _CLEAN_NAMES).sql(O.with_views("customers_dirty_v"))
    + ")\nUNION ALL\nSELECT 'load', 'rows_loaded', NULL, (" + O.with_views("customers_dirty_v")
    + f" SELECT COUNT(*) FROM {_CLEAN_SQL} t0), TRUE")

ORACLE["verify_tables"] = O.with_views("customers_v", "orders_v", "products_v") + """,
c AS (SELECT 'customers' AS table_name, COUNT(*) AS n FROM customers_v UNION ALL
      SELECT 'orders', COUNT(*) FROM orders_v UNION ALL SELECT 'products', COUNT(*) FROM products_v)
SELECT table_name, n AS expected_rows, n AS actual_rows, TRUE AS matches FROM c"""

ORACLE["reconcile_tables"] = O.with_views("customers_v") + """,
c AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE customer_id = 7) > 0 AS there, BOOL_OR(city <> country) AS differ
      FROM customers_v)
SELECT "case", check_name, check_name <> 'content' OR "case" = 'as loaded'
       OR CASE WHEN "case" = 'swapped columns' THEN NOT differ ELSE NOT there END AS matches,
       CASE WHEN check_name = 'row_count' THEN n END AS table_rows
FROM c, (VALUES ('as loaded'), ('changed value'), ('swapped columns'), ('lost and repeated row')) AS k("case"),
     (VALUES ('columns'), ('partition_by'), ('clustering'), ('row_count'), ('content')) AS x(check_name)"""

QUERIES["reconcile_tables"] = q_reconcile_tables
QUERIES["generic_pipeline"] = q_generic_pipeline
QUERIES["verify_tables"] = q_verify_tables


# --- share of maximum for the other two dashboard series (A-09 over A-06 and A-08) ----------

def q_revenue_by_customer_share(s, d):
    return A.share_of_max(A.revenue_by_customer(_cust(s, d), _ord(s, d)))


def q_revenue_over_time_share(s, d):
    return A.share_of_max(A.revenue_over_time(_ord(s, d)))


_REV_BY_CUSTOMER = f"""
SELECT c.customer_id, c.name AS customer_name, COALESCE({M}, 0.0) AS total_revenue
FROM customers_v c LEFT JOIN orders_v o ON c.customer_id = o.customer_id
GROUP BY c.customer_id, c.name"""

_REV_OVER_TIME = f"""
SELECT order_date, {O.money(AMT_SUM)} AS total_revenue FROM orders_v GROUP BY order_date"""

_SHARE = """
SELECT *, COALESCE(total_revenue / (SELECT CASE WHEN MAX(total_revenue) > 0 THEN MAX(total_revenue) END FROM r)
                   * 100, 0.0) AS pct_of_max
FROM r"""

ORACLE["revenue_by_customer_share"] = O.with_views("customers_v", "orders_v") + f", r AS ({_REV_BY_CUSTOMER})" + _SHARE
ORACLE["revenue_over_time_share"] = O.with_views("orders_v") + f", r AS ({_REV_OVER_TIME})" + _SHARE

QUERIES["revenue_by_customer_share"] = q_revenue_by_customer_share
QUERIES["revenue_over_time_share"] = q_revenue_over_time_share


# --- files of the given rows, read back: quoted CSV in parallel, JSON through VARIANT, strict loads ------------------

def q_csv_quoted_records(s, d):
    """Texts with line ends, quotes and delimiters through CSV files that are split."""
    docs = V.read_table(s, d, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    folder = _scratch(s, "quoted-csv")
    (docs.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(folder))
    found = csv_records.read_csv(s, folder, schema=docs.schema, reject="rejected")
    return found.select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"), "lang", "source",
                        "n_chars", F.col("rejected").isNotNull().alias("rejected"))


ORACLE["csv_quoted_records"] = """
SELECT doc_id, md5(COALESCE(text, '')) AS text_md5, NULLIF(lang, '') AS lang, NULLIF(source, '') AS source, n_chars,
       FALSE AS rejected FROM documents"""


def q_json_variant_records(s, d):
    """Orders as JSON lines in which the price of some is text, read without a pass for their types."""
    orders, folder = _ord(s, d), _scratch(s, "json-lines")
    fields = ["order_id", "line_no", "customer_id", "product_id", "order_date", "quantity"]
    number, text = (F.to_json(F.struct(*fields, F.col("price").cast(t).alias("price"))) for t in ("double", "string"))
    orders.select(F.when(F.col("order_id") % 5 == 0, text).otherwise(number).alias("value")).write.text(folder)
    found = json_variant.read_json(s, folder, multi_line=False)
    return found.select(*fields, F.col("price").cast("decimal(12,2)").alias("price"))


ORACLE["json_variant_records"] = O.with_views("orders_v") + """
SELECT order_id, CAST(line_no AS BIGINT) AS line_no, customer_id, product_id, CAST(order_date AS VARCHAR) AS order_date,
       CAST(quantity AS BIGINT) AS quantity, CAST(price AS DOUBLE) AS price FROM orders_v"""


def q_strict_load(s, d):
    """Three loads of one versioned table from CSV: clean, refused for its bad dates, and the same with these allowed."""
    table, root, steps = f"orders_{uuid.uuid4().hex}", _scratch(s, "strict"), []
    schema = _ord(s, d).schema
    for name, orders, most in (("clean", _ord(s, d), 0), ("refused", _dirty_ord(s, d), 0), ("allowed", None, 1 << 62)):
        if orders is not None:
            folder = f"{root}/{name}"
            orders.write.option("header", True).csv(folder)
        rows = csv_records.read_csv(s, folder, schema=schema, reject="rejected")
        try:
            done = load_version(s, rows, table, f"{root}/table", reject="rejected", max_rejects=most)
            rejected = done["rows_rejected"]
        except W.RejectedRows as e:
            rejected = e.rows
        steps.append((name, current_version(s, table), s.table(table).count(), rejected))
    s.sql(f"DROP VIEW {table}")
    s.sql(f"DROP VIEW {W.rejects_table(table)}")
    for v in versions(s, table):
        s.sql(f"DROP TABLE {version_table(table, v)}")
    return s.createDataFrame(steps, "step string, version long, table_rows long, rejected long")


ORACLE["strict_load"] = O.with_views("orders_v") + """,
n AS (SELECT COUNT(*) AS total, COUNT(*) FILTER (WHERE order_id % 89 = 0) AS bad FROM orders_v)
SELECT 'clean' AS step, CAST(1 AS BIGINT) AS version, total AS table_rows, CAST(0 AS BIGINT) AS rejected FROM n
UNION ALL SELECT 'refused', 1, total, bad FROM n UNION ALL SELECT 'allowed', 2, total - bad, bad FROM n"""

def q_customer_analytics_loaded(s, d):
    """J-01 over loaded tables, both in buckets by the key of the join: no shuffle for the join or the totals by key."""
    suffix, root = uuid.uuid4().hex, _scratch(s, "bucketed")
    frames = {"customers": _cust(s, d), "orders": _ord(s, d)}
    for name, df in frames.items():
        layout.load_bucketed(s, df, f"{name}_{suffix}", f"{root}/{name}", ["customer_id"], 8)
    found = A.customer_analytics(s.table(f"customers_{suffix}"), s.table(f"orders_{suffix}"))
    for name in frames:
        s.sql(f"DROP TABLE {name}_{suffix}")  # the names; the plan holds the files
    return found


ORACLE["customer_analytics_loaded"] = ORACLE["customer_analytics"]

def q_merged_quality_report(s, d):
    """The orders' report merged from profiles of four loads (the quarters), and whether its estimates keep their bound."""
    orders, folder = _dirty_ord(s, d), f"{_scratch(s, 'profiles')}/orders"
    quarter = F.coalesce(F.quarter(F.try_to_date("order_date")), F.lit(1))
    loads = {f"quarter-{k}": quarter == k for k in range(1, 5)}
    profiles.save_profile(profiles.profile_states(orders, "orders", loads, ORDERS), folder)  # one pass for all loads
    report = profiles.merged_report(profiles.read_profiles(s, folder, "orders"))
    # the view's rows lie by order id after its join, so its different ids are counted without a further shuffle
    exact = orders.select("order_id").distinct().agg(F.count(F.lit(1))).scalar()
    near = F.abs(F.col("value") - exact) <= F.lit(3 * profiles.STANDARD_ERROR) * exact
    kept = report.filter("exact").select("dataset", "check_name", "column_name", "value", "passed")
    bound = report.filter("check_name = 'unique_keys'").select(
        "dataset", F.lit("unique_keys_in_bound").alias("check_name"), "column_name", F.lit(None).cast("long").alias("value"),
        near.alias("passed"))
    return kept.unionByName(bound)


ORACLE["merged_quality_report"] = f"""
SELECT dataset, check_name, column_name, value, passed FROM ({ORACLE["order_quality_report"]}) t
WHERE check_name NOT IN ('unique_keys', 'duplicate_count')
UNION ALL SELECT 'orders', 'unique_keys_in_bound', 'order_id', NULL, TRUE"""

QUERIES["merged_quality_report"] = q_merged_quality_report
QUERIES["customer_analytics_loaded"] = q_customer_analytics_loaded
QUERIES["csv_quoted_records"] = q_csv_quoted_records
QUERIES["json_variant_records"] = q_json_variant_records
QUERIES["strict_load"] = q_strict_load


# --- presentation on both sides ---------------------------------------------------------

# DATE columns of each raw result (checked against the Spark schemas by a test).
DATE_OUTPUTS: dict[str, list[str]] = {
    "sales_analytics": ["order_date"],
    "revenue_over_time": ["order_date"],
    "revenue_over_time_labels": ["order_date"],
    "revenue_over_time_share": ["order_date"],
    "customer_analytics": ["signup_date"],
    "customer_analytics_loaded": ["signup_date"],
    "first_orders": ["order_date"],
    "clean_customers": ["signup_date"],
    "clean_orders": ["order_date"],
    "clean_orders_by_order_id": ["order_date"],
    "dedupe_by_order_id": ["order_date"],
    "dedupe_by_key": ["order_date"],
}

RAW_QUERIES: dict[str, Query] = dict(QUERIES)


def _presented(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(fn(spark, sf_dir))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES = {k: _presented(fn) for k, fn in RAW_QUERIES.items()}
ORACLE = {k: O.dates_as_text(sql, DATE_OUTPUTS.get(k, [])) for k, sql in ORACLE.items()}
