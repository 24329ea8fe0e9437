"""The three typed entities of the sales data model and their contracts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class EntitySpec:
    """What a typed entity must look like.

    ``columns``: required column names (the report checks names only);
    ``key``: columns that identify one record; ``positive``: numeric columns whose
    values must be > 0; ``schema``: the explicit type used when reading it typed.
    """

    name: str
    columns: tuple[str, ...]
    key: tuple[str, ...]
    positive: tuple[str, ...] = ()
    schema: T.StructType = field(default=None, compare=False)


CUSTOMERS_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("signup_date", T.DateType()),
])

ORDERS_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("price", T.DecimalType(12, 2)),
])

PRODUCTS_SCHEMA = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
])

CUSTOMERS = EntitySpec(
    name="customers",
    columns=("customer_id", "name", "email", "city", "country", "signup_date"),
    key=("customer_id",),
    schema=CUSTOMERS_SCHEMA,
)

ORDERS = EntitySpec(
    name="orders",
    columns=("order_id", "customer_id", "product_id", "order_date", "quantity", "price"),
    key=("order_id",),
    positive=("quantity", "price"),
    schema=ORDERS_SCHEMA,
)

PRODUCTS = EntitySpec(
    name="products",
    columns=("product_id", "product_name", "category"),
    key=("product_id",),
    schema=PRODUCTS_SCHEMA,
)

ENTITIES = {spec.name: spec for spec in (CUSTOMERS, ORDERS, PRODUCTS)}
