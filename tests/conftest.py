from __future__ import annotations

import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"

# Fixture data, by rule, with the defects that the cleaners and checks are for: 15 customer rows (305 twice, 311
# without e-mail), 12 orders (711 with a negative quantity, 712 with a negative price), 5 products.
_PLACES = ["Oslo,Norway", "Lima,Peru", "Accra,Ghana"]
_MEMBERS = [*range(301, 311), 305, *range(311, 315)]
CUSTOMERS_CSV = "customer_id,name,email,city,country,signup_date\n" + "".join(
    f"{k},Member {k - 300},{'' if k == 311 else f'm{k}@shop.test'},{_PLACES[k % 3]},2024-03-{k - 300:02}\n"
    for k in _MEMBERS)

_PRODUCTS = [(41, "Lamp", "Home", 120.5), (42, "Kettle", "Kitchen", 80.0), (43, "Notebook", "Office", 15.25),
             (44, "Desk", "Home", 310.0), (45, "Pencil", "Office", 9.75)]
_PRICE = {k: price for k, _, _, price in _PRODUCTS}
_LINES = [(41, 2), (42, 1), (43, 3), (44, 1), (41, 1), (45, 4), (42, 2), (43, 5), (44, 1), (45, 3), (42, -1), (41, 2)]
_ORDERS = [(701 + k, 301 + k, product, f"2024-05-{1 + 2 * k:02}", quantity, _PRICE[product] * (-1 if k == 11 else 1))
           for k, (product, quantity) in enumerate(_LINES)]
ORDERS_JSON = json.dumps(
    [dict(zip(("order_id", "customer_id", "product_id", "order_date", "quantity", "price"), o)) for o in _ORDERS])

PRODUCTS_XML = "<?xml version='1.0'?>\n<products>\n" + "".join(
    f"<product><product_id>{i}</product_id><product_name>{n}</product_name><category>{c}</category></product>\n"
    for i, n, c, _ in _PRODUCTS) + "</products>\n"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    s = local_session("*", 8, app="ledgerlake-tests", extra={
        "spark.checkpoint.dir": str(shared / "checkpoints"), "spark.sql.warehouse.dir": str(shared / "warehouse")})
    yield s


@pytest.fixture(scope="session")
def fixture_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("landing")
    (d / "customers.csv").write_text(CUSTOMERS_CSV)
    (d / "orders.json").write_text(ORDERS_JSON)
    (d / "products.xml").write_text(PRODUCTS_XML)
    return d


@pytest.fixture(scope="session")
def raw_tables(spark, fixture_dir):
    from ledgerlake.sources.files import load_csv, load_json, load_xml
    return {
        "customers": load_csv(spark, str(fixture_dir / "customers.csv")),
        "orders": load_json(spark, str(fixture_dir / "orders.json")),
        "products": load_xml(spark, str(fixture_dir / "products.xml")),
    }


@pytest.fixture(scope="session")
def typed_tables(raw_tables):
    """The typed path: cast to the entity types, then the typed cleaners."""
    from ledgerlake.entities import CUSTOMERS, ORDERS, PRODUCTS
    from ledgerlake.operators import cleaning as C
    return {
        "customers": C.clean_customers(C.cast_to_entity(raw_tables["customers"], CUSTOMERS)),
        "orders": C.clean_orders(C.cast_to_entity(raw_tables["orders"], ORDERS)),
        "products": C.clean_products(C.cast_to_entity(raw_tables["products"], PRODUCTS)),
    }
