from __future__ import annotations

import datetime as dt

from ledgerlake.functions.naming import (choose_clustering_columns, normalize_column_name, normalize_table_name,
                                         unique_names)
from ledgerlake.operators import cleaning as C


def test_typed_cleaning_counts(typed_tables):
    assert typed_tables["customers"].count() == 14
    assert typed_tables["orders"].count() == 10
    assert typed_tables["products"].count() == 5


def test_clean_orders_drops_non_positive(typed_tables):
    o = typed_tables["orders"]
    assert o.filter("quantity <= 0 OR price <= 0").count() == 0
    assert dict(o.dtypes)["order_date"] == "date"


def test_products_unique(typed_tables):
    p = typed_tables["products"]
    assert p.select("product_id").distinct().count() == 5


def test_generic_cleaning_counts(raw_tables):
    assert C.clean_dataframe(raw_tables["customers"]).count() == 14
    assert C.clean_dataframe(raw_tables["orders"]).count() == 12
    assert C.clean_dataframe(raw_tables["products"]).count() == 5


def test_clean_strings_trims_and_nulls(spark):
    df = spark.createDataFrame([(1, "  a ", "   ", "\tb"), (2, None, "", "c")], "k int, x string, y string, z string")
    out = {r["k"]: r for r in C.clean_strings(df).collect()}
    assert out[1]["x"] == "a" and out[1]["y"] is None
    assert out[1]["z"] == "\tb"  # trim removes spaces only
    assert out[2]["x"] is None and out[2]["y"] is None


def test_drop_duplicates_after_trim(spark):
    df = spark.createDataFrame([(1, "a"), (1, " a "), (1, "a"), (2, None), (2, "")], "k int, v string")
    assert C.clean_dataframe(df).count() == 2


def test_drop_duplicates_with_map_column(spark):
    df = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 1})], "k int, m map<string,int>")
    assert C.drop_duplicate_rows(df).count() == 1


def test_dedupe_by_key_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (1, None, 5), (2, "z", 1), (None, "x", 1), (None, "w", 3)],
                               "k int, s string, n int")
    out = {r["k"]: (r["s"], r["n"]) for r in C.dedupe_by_key(df, ["k"]).collect()}
    assert out == {1: (None, 5), 2: ("z", 1), None: ("w", 3)}
    out2 = {r["k"]: (r["s"], r["n"]) for r in C.dedupe_by_key(df, ["k"], order_by=["n"]).collect()}
    assert out2[1] == ("b", 2)
    assert C.dedupe_by_key(df, ["k"], deterministic=False).count() == 3


def test_dedupe_plan_aggregates_map_side(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS v")
    plan = C.dedupe_by_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_bad_dates_become_null(spark):
    df = spark.createDataFrame([(1, 1, 1, "2025-01-02", 1, 1.0), (2, 1, 1, "not-a-date", 1, 1.0)],
                               "order_id long, customer_id long, product_id long, order_date string, quantity long, "
                               "price double")
    out = {r["order_id"]: r["order_date"] for r in C.clean_orders(df).collect()}
    assert out == {1: dt.date(2025, 1, 2), 2: None}


def test_reject_orders_reasons(raw_tables):
    rej = {r["order_id"]: r["reject_reason"] for r in C.reject_orders(raw_tables["orders"]).collect()}
    assert rej == {711: "quantity_not_positive", 712: "price_not_positive"}


def test_customers_email_lowered(spark):
    df = spark.createDataFrame([(1, " A ", " X@Y.COM ", " c ", " d ", "2025-01-01")],
                               "customer_id long, name string, email string, city string, country string, "
                               "signup_date string")
    r = C.clean_customers(df).collect()[0]
    assert (r["name"], r["email"], r["city"], r["country"]) == ("A", "x@y.com", "c", "d")
    assert r["signup_date"] == dt.date(2025, 1, 1)


def test_column_name_rules():
    assert normalize_column_name("Order Date") == "order_date"
    assert normalize_column_name("Sales($)") == "sales"
    assert normalize_column_name("1st") == "column_1st"
    assert normalize_column_name("_c4") == "c4"
    assert normalize_column_name("___") == "column"
    assert unique_names(["a", "A", "a_2", "a"]) == ["a", "a_2", "a_2_2", "a_3"]


def test_table_name_rules():
    assert normalize_table_name("customers_processed.csv") == "customers"
    assert normalize_table_name("Sample - Superstore_processed.csv") == "sample_superstore"
    assert normalize_table_name("2024.csv") == "table_2024"
    assert normalize_table_name("___.csv") == "dataset"


def test_clustering_choice():
    assert choose_clustering_columns(["order_id", "city", "customer_id"]) == ["customer_id", "order_id"]
    assert choose_clustering_columns(["x"]) == []


def test_spaces_fixture_generic_and_typed(spark, tmp_path):
    from ledgerlake.entities import CUSTOMERS
    from ledgerlake.operators.quality import generate_customer_quality_report, report_as_dict
    from ledgerlake.sources.files import load_csv
    p = tmp_path / "spaces.csv"
    p.write_text("customer_id,name,email,city,country,signup_date\n"
                 "1, Ann ,A@X.COM,  Paris,FR,2025-01-02\n"
                 "1,Ann,a@x.com,Paris,FR,2025-01-02\n"
                 "2,Bob,   ,Rome\t,IT,2025-02-30\n")
    raw = load_csv(spark, str(p))
    generic = C.clean_dataframe(raw).collect()
    assert len(generic) == 3  # e-mail case differs, so the two rows of customer 1 stay distinct
    assert {r.email for r in generic} == {"A@X.COM", "a@x.com", None}  # all-space -> NULL
    assert {r.city for r in generic} == {"Paris", "Rome\t"}  # trim removes spaces, not tabs
    typed = {r.customer_id: r for r in C.clean_customers(C.cast_to_entity(raw, CUSTOMERS)).collect()}
    assert len(typed) == 2 and typed[1].email == "a@x.com" and typed[1].name == "Ann"
    assert typed[2].email == "" and typed[2].signup_date is None  # typed cleaners keep '' ; bad date -> NULL
    rep = report_as_dict(generate_customer_quality_report(raw))
    assert rep["dates"]["unparsable_counts"] == {"signup_date": 1}


def test_dedupe_with_map_column(spark):
    df = spark.createDataFrame([(1, {"b": 1}, 5), (1, {"a": 9}, 7), (2, None, 1)], "k int, m map<string,int>, n int")
    out = {r["k"]: (r["m"], r["n"]) for r in C.dedupe_by_key(df, ["k"]).collect()}
    assert out == {1: ({"a": 9}, 7), 2: (None, 1)}  # '{"a":9}' sorts before '{"b":1}'
