from __future__ import annotations

from ledgerlake.operators import quality as Q


def _scans(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan")


def test_required_columns_pass(raw_tables):
    rep = Q.report_as_dict(Q.check_required_columns(
        raw_tables["customers"], ["customer_id", "name", "email", "city", "country", "signup_date"], "customers"))
    assert rep["schema"]["passed"] is True
    assert rep["schema"]["missing_columns"] == [] and rep["schema"]["unexpected_columns"] == []


def test_required_columns_missing(raw_tables):
    rep = Q.report_as_dict(Q.check_required_columns(raw_tables["products"], ["product_id", "price"], "p"))
    assert rep["schema"]["passed"] is False
    assert rep["schema"]["missing_columns"] == ["price"]
    assert rep["schema"]["unexpected_columns"] == ["category", "product_name"]


def test_null_email(raw_tables):
    rep = Q.report_as_dict(Q.check_nulls(raw_tables["customers"], ["customer_id", "email"], "customers"))
    assert rep["nulls"]["null_counts"]["email"] == 1
    assert rep["nulls"]["passed"] is False


def test_duplicate_customer(raw_tables):
    rep = Q.report_as_dict(Q.check_duplicates(raw_tables["customers"], ["customer_id"], "customers"))
    assert rep["duplicates"] == {"passed": False, "total_rows": 15, "unique_rows": 14, "duplicate_count": 1}


def test_positive_values(raw_tables):
    rep = Q.report_as_dict(Q.check_positive_values(raw_tables["orders"], ["quantity", "price"], "orders"))
    assert rep["positive_values"]["invalid_counts"] == {"quantity": 1, "price": 1}
    assert rep["positive_values"]["passed"] is False


def test_customer_report(raw_tables):
    rep = Q.report_as_dict(Q.generate_customer_quality_report(raw_tables["customers"]))
    assert rep["dataset"] == "customers" and rep["row_count"] == 15
    assert rep["schema"]["passed"] is True
    assert rep["nulls"]["passed"] is False
    assert rep["duplicates"]["duplicate_count"] == 1


def test_order_report(raw_tables):
    rep = Q.report_as_dict(Q.generate_order_quality_report(raw_tables["orders"]))
    assert rep["dataset"] == "orders" and rep["row_count"] == 12
    assert rep["duplicates"]["passed"] is True
    assert rep["positive_values"]["invalid_counts"] == {"quantity": 1, "price": 1}


def test_product_report(raw_tables):
    rep = Q.report_as_dict(Q.generate_product_quality_report(raw_tables["products"]))
    assert rep["dataset"] == "products" and rep["row_count"] == 5
    assert rep["nulls"]["passed"] is True and rep["duplicates"]["passed"] is True


def test_generic_report(raw_tables):
    rep = Q.report_as_dict(Q.generate_quality_report(raw_tables["customers"], "customers.csv"))
    assert rep["row_count"] == 15 and rep["column_count"] == 6
    assert rep["schema"] == {"passed": True, "column_count": 6}
    assert rep["nulls"]["passed"] is True and rep["nulls"]["total_nulls"] == 1  # informational
    assert rep["duplicates"] == {"passed": False, "duplicate_rows": 1}


def test_null_keys_form_a_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, None)], "a int, b int")
    rep = Q.report_as_dict(Q.check_duplicates(df, ["a", "b"], "t"))
    assert rep["duplicates"]["unique_rows"] == 2


def test_empty_input_gives_zero(spark):
    df = spark.createDataFrame([], "quantity int, price double")
    rep = Q.report_as_dict(Q.generate_order_quality_report(df))
    assert rep["row_count"] == 0
    assert rep["schema"]["passed"] is False
    assert rep["positive_values"]["invalid_counts"] == {"quantity": 0, "price": 0}


def test_report_is_one_scan(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.range(1000).selectExpr("id AS order_id", "id % 7 AS customer_id", "id % 5 AS product_id",
                                 "CAST(NULL AS DATE) AS order_date", "id % 4 AS quantity", "1.5 AS price"
                                 ).write.parquet(p)
    df = spark.read.parquet(p)
    report = Q.generate_order_quality_report(df)
    assert _scans(report) == 1
    assert report.count() > 0
    assert "PythonUDF" not in report._jdf.queryExecution().executedPlan().toString()


def test_unparsable_dates_counted(spark, raw_tables):
    rep = Q.report_as_dict(Q.generate_order_quality_report(raw_tables["orders"]))
    assert rep["dates"] == {"passed": True, "unparsable_counts": {"order_date": 0}}
    bad = raw_tables["orders"].selectExpr("* EXCEPT (order_date)",
                                          "CASE WHEN order_id = 703 THEN '2025-13-45' ELSE order_date END AS order_date")
    rep = Q.report_as_dict(Q.generate_order_quality_report(bad))
    assert rep["dates"] == {"passed": False, "unparsable_counts": {"order_date": 1}}
    typed = Q.report_as_dict(Q.generate_customer_quality_report(raw_tables["customers"]))
    assert "dates" not in typed  # signup_date is already a DATE
