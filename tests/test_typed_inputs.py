"""Typed runs read by header or field names, not by position."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest

from ledgerlake.plans import pipeline as P
from ledgerlake.sinks import warehouse as W

NAMES = ["order_id", "customer_id", "product_id", "order_date", "quantity", "price"]
WANT = [(1, 11, 21, dt.date(2024, 5, 1), 2, Decimal("9.50")), (2, 12, 22, dt.date(2024, 5, 2), 3, Decimal("1.25"))]


def loaded(spark, path, tmp_path):
    P.process_dataset(spark, str(path), path.name, str(tmp_path / "wh"), entity="orders")
    table = W.read_table(spark, P.normalize_table_name(path.name))
    return sorted(tuple(r) for r in table.select(*NAMES).collect()), table.columns


def test_csv_columns_in_another_order_and_further_ones(spark, tmp_path):
    p = tmp_path / "turned_orders.csv"
    p.write_text("Price,Note,Order ID,quantity,order_date,product_id,customer_id\n"
                 "9.50,gift,1,2.0,2024-05-01,21,11\n1.25,,2,3,2024-05-02,22,12\n3,bad,3,-1,2024-05-03,22,12\n")
    rows, columns = loaded(spark, p, tmp_path)
    assert rows == WANT and "note" in columns


@pytest.mark.parametrize("lines", [False, True])
def test_json_fields_by_normalised_name(spark, tmp_path, lines):
    p = tmp_path / f"named_orders_{int(lines)}.json"
    records = [{"Order ID": 1, "Customer Id": "11", "product_id": 21, "order_date": "2024-05-01", "quantity": 2.0,
                "price": 9.5, "note": "gift"},
               {"Order ID": 2, "Customer Id": "12", "product_id": 22, "order_date": "2024-05-02", "quantity": 3,
                "price": 1.25}]
    p.write_text("\n".join(map(json.dumps, records)) if lines else json.dumps(records))
    if lines:
        P.process_dataset(spark, str(p), p.name, str(tmp_path / "wh"), entity="orders", multi_line=False)
        table = W.read_table(spark, "named_orders_1")
        rows, columns = sorted(tuple(r) for r in table.select(*NAMES).collect()), table.columns
    else:
        rows, columns = loaded(spark, p, tmp_path)
    assert rows == WANT and "note" in columns


def test_a_missing_column_raises_and_an_empty_input_loads(spark, tmp_path):
    p = tmp_path / "short_orders.csv"
    p.write_text("order_id,customer_id,product_id,order_date,quantity\n1,11,21,2024-05-01,2\n")
    with pytest.raises(ValueError, match="price"):
        loaded(spark, p, tmp_path)
    p = tmp_path / "no_orders.json"
    p.write_text("[]")
    assert loaded(spark, p, tmp_path)[0] == []


def test_files_with_other_headers_raise(spark, tmp_path):
    d = tmp_path / "mixed_orders.csv"
    d.mkdir()
    (d / "a.csv").write_text(",".join(NAMES) + "\n1,11,21,2024-05-01,2,9.50\n")
    (d / "b.csv").write_text(",".join(NAMES[::-1]) + "\n1.25,3,2024-05-02,22,12,2\n")
    with pytest.raises(Exception, match="CSV header"):
        loaded(spark, d, tmp_path)
