from __future__ import annotations

import json

import pytest
from pyspark.errors import StreamingQueryException

from ledgerlake.streaming.ingest import ingest


def _orders(ids, qty=1):
    return json.dumps([{"order_id": i, "customer_id": 1, "product_id": 2, "order_date": "2025-04-01",
                        "quantity": qty, "price": 9.5} for i in ids])


def test_incremental_ingest(spark, tmp_path):
    land, table, ckpt = tmp_path / "land", str(tmp_path / "orders_tbl"), str(tmp_path / "ckpt")
    land.mkdir()
    (land / "a.json").write_text(_orders([1, 2, 3]))
    (land / "b.json").write_text(_orders([4], qty=-1))  # filtered out
    ingest(spark, str(land), "orders", table, checkpoint=ckpt, dedupe_within="7 days").awaitTermination()
    assert sorted(r.order_id for r in spark.read.parquet(table).collect()) == [1, 2, 3]
    # second run: only the new file is read; a re-sent key is dropped within the watermark
    (land / "c.json").write_text(_orders([3, 5]))
    ingest(spark, str(land), "orders", table, checkpoint=ckpt, dedupe_within="7 days").awaitTermination()
    assert sorted(r.order_id for r in spark.read.parquet(table).collect()) == [1, 2, 3, 5]


def test_an_order_with_an_older_date_is_stored(spark, tmp_path):
    land, table, ckpt = tmp_path / "land", str(tmp_path / "t"), str(tmp_path / "ckpt")
    land.mkdir()
    for k, date in enumerate(["2025-06-01", "2025-01-01", "2024-01-01"]):
        (land / f"{k}.json").write_text(_orders([k]).replace("2025-04-01", date))
        ingest(spark, str(land), "orders", table, checkpoint=ckpt, dedupe_within="1 hour").awaitTermination()
    assert sorted(r.order_id for r in spark.read.parquet(table).collect()) == [0, 1, 2]


def test_ingest_csv_customers(spark, tmp_path):
    land, table = tmp_path / "land", str(tmp_path / "customers_tbl")
    land.mkdir()
    (land / "a.csv").write_text("customer_id,name,email,city,country,signup_date\n"
                                "1, Ann ,A@X.COM,Paris,FR,2025-01-02\n2,Bob,,Rome,IT,not-a-date\n")
    ingest(spark, str(land), "customers", table, fmt="csv", checkpoint=str(tmp_path / "ck")).awaitTermination()
    rows = {r.customer_id: r for r in spark.read.parquet(table).collect()}
    assert rows[1].name == "Ann" and rows[1].email == "a@x.com"
    assert rows[2].email is None and rows[2].signup_date is None


def test_backlog_in_bounded_batches(spark, tmp_path):
    land, table = tmp_path / "land", str(tmp_path / "t")
    land.mkdir()
    for i in range(4):
        (land / f"f{i}.json").write_text(_orders([10 * i + 1, 10 * i + 2]))
    q = ingest(spark, str(land), "orders", table, checkpoint=str(tmp_path / "ck"), max_files_per_trigger=1)
    q.awaitTermination()
    assert q.lastProgress is not None and q.lastProgress["numInputRows"] == 1  # one file, a document, per batch
    assert spark.read.parquet(table).count() == 8


def test_csv_columns_by_header(spark, tmp_path):
    """A header in another order, with another, a further or a missing name fails; quotes are escaped by doubling."""
    head, row = "product_id,product_name,category".split(","), '1,"A ""big"", lamp",Home'.split(",", 1)
    land, table = tmp_path / "land", str(tmp_path / "products_tbl")
    land.mkdir()
    (land / "a.csv").write_text(",".join(head) + "\n" + ",".join(row) + "\n")
    ingest(spark, str(land), "products", table, fmt="csv", checkpoint=str(tmp_path / "ck")).awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(table).collect()] == [(1, 'A "big", lamp', "Home")]
    for k, names in enumerate(("category,product_name,product_id", "product_id,name,category", "product_id,product_name",
                               "product_id,product_name,category,more")):
        bad = tmp_path / f"bad{k}"
        bad.mkdir()
        (bad / "b.csv").write_text(f"{names}\n" + ",".join(["2"] * len(names.split(","))) + "\n")
        out = str(tmp_path / f"t{k}")
        with pytest.raises(StreamingQueryException, match="FAILED_READ_FILE"):
            ingest(spark, str(bad), "products", out, name=f"bad{k}", fmt="csv", checkpoint=f"{out}-ck").awaitTermination()


def test_json_fields_by_normalised_name(spark, tmp_path):
    land, table = tmp_path / "land", str(tmp_path / "orders_tbl")
    land.mkdir()
    (land / "a.json").write_text(json.dumps([
        {"price": "2.50", "Order ID": 7, "Customer-Id": "701", "product_id": 3.0, "ORDER DATE": "2025-04-01", "quantity": 2,
         "note": "more"}, {"order_id": 8, "customer_id": 1, "product_id": 1, "quantity": 1, "price": 1}]))
    ingest(spark, str(land), "orders", table, name="named", checkpoint=str(tmp_path / "ck")).awaitTermination()
    found = spark.read.parquet(table).orderBy("order_id").collect()
    assert [(r.order_id, r.customer_id, str(r.price), str(r.order_date)) for r in found] == [
        (7, 701, "2.50", "2025-04-01"), (8, 1, "1.00", "None")]
