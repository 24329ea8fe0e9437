"""Merged profiles give the report over all rows: counts exactly, different keys within the sketch's bound."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlake.entities import CUSTOMERS, ORDERS
from ledgerlake.operators import profiles as P
from ledgerlake.operators import quality as Q
from ledgerlake.sources import tables as V

SF = "/root/testdata/sf0.001"
ESTIMATES = ("unique_keys", "duplicate_count", "duplicate_rows")


def rows(df, *without):
    return sorted(map(repr, [tuple(r) for r in df.collect() if r["check_name"] not in without]))


def by_load(df, key, path, entity=None, loads=3):
    for k in range(loads):
        P.save_profile(P.profile_state(df.filter(F.pmod(F.xxhash64(key), F.lit(loads)) == k), "data", f"load {k}", entity),
                       path)


@pytest.mark.parametrize("entity,view", [(ORDERS, V.orders_dirty_view), (CUSTOMERS, V.customers_dirty_view)])
def test_an_entity_report_of_all_loads(spark, tmp_path, entity, view):
    df = view(spark, SF)
    by_load(df, df.columns[0], str(tmp_path), entity)
    report = P.merged_report(P.read_profiles(spark, str(tmp_path), "data"))
    full = Q.entity_quality_report(df, entity).withColumn("dataset", F.lit("data"))
    exact = report.filter("exact").drop("exact").select(*full.columns)
    assert rows(exact) == rows(full, *ESTIMATES)
    want = {r["check_name"]: r["value"] for r in full.collect() if r["check_name"] in ESTIMATES}
    got = {r["check_name"]: r["value"] for r in report.filter("NOT exact").collect()}
    assert got.keys() == want.keys()
    assert abs(got["unique_keys"] - want["unique_keys"]) <= 3 * P.STANDARD_ERROR * want["unique_keys"]
    total = next(r["value"] for r in full.collect() if r["check_name"] == "row_count")
    assert got["duplicate_count"] == total - got["unique_keys"]


def test_a_generic_report_of_all_loads(spark, tmp_path):
    df = V.customers_dirty_view(spark, SF)
    by_load(df, "customer_id", str(tmp_path))
    report = P.merged_report(P.read_profiles(spark, str(tmp_path), "data"))
    full = Q.generate_quality_report(df, "data")
    assert rows(report.filter("exact").drop("exact").select(*full.columns)) == rows(
        full, "duplicate_rows", "column_count", "schema")
    want, got = (next(r["value"] for r in x.collect() if r["check_name"] == "duplicate_rows") for x in (full, report))
    assert abs(want - got) <= 3 * P.STANDARD_ERROR * df.count()


def test_the_same_load_again_and_another_dataset(spark, tmp_path):
    df = spark.range(1000).selectExpr("id AS order_id", "id % 7 AS quantity")
    for _ in range(2):
        P.save_profile(P.profile_state(df, "data", "load 1"), str(tmp_path))
    P.save_profile(P.profile_state(df, "other", "load 1"), str(tmp_path))
    P.save_profile(P.profile_state(df.limit(0), "data", "load 2"), str(tmp_path))
    report = {r["check_name"]: r for r in P.merged_report(P.read_profiles(spark, str(tmp_path), "data")).collect()}
    assert report["row_count"]["value"] == 1000 and report["duplicate_rows"]["value"] <= 25


def test_no_old_rows_are_read_and_sketches_stay_small(spark, tmp_path):
    df = spark.range(200_000).selectExpr("id AS order_id", "id % 5 AS quantity", "'x' AS note")
    by_load(df, "order_id", str(tmp_path), ORDERS)
    states = P.read_profiles(spark, str(tmp_path), "data")
    assert states.count() < 60
    assert states.agg(F.max(F.octet_length("sketch"))).first()[0] <= 2 ** P.SKETCH_BITS + 100
    report = {(r["check_name"], r["column_name"]): r for r in P.merged_report(states).collect()}
    assert abs(report["unique_keys", "order_id"]["value"] - 200_000) <= 3 * P.STANDARD_ERROR * 200_000
    assert report["invalid_count", "quantity"]["value"] == 40_000 and not report["schema", None]["passed"]
    assert report["missing_column", "price"]["value"] == 1 and report["unexpected_column", "note"]["passed"]


def test_several_loads_in_one_pass(spark, tmp_path):
    df = spark.range(500).selectExpr("id AS order_id", "nullif(id % 5, 3) AS quantity", "'2024-13-01' AS order_date")
    loads = {"low": F.col("order_id") < 200, "high": F.col("order_id") >= 200, "none": F.col("order_id") < 0}
    at_once = P.profile_states(df, "data", loads, ORDERS)
    one_by_one = [P.profile_state(df.filter(inside), "data", k, ORDERS) for k, inside in loads.items()]

    def found(states):
        return sorted(map(repr, states.withColumn("sketch", F.hll_sketch_estimate("sketch")).collect()))
    assert found(at_once) == sorted(sum(map(found, one_by_one), []))
    assert at_once._jdf.queryExecution().toString().count("Range (0, 500") == one_by_one[0]._jdf.queryExecution().toString(
        ).count("Range (0, 500")  # the rows are read once
    P.save_profile(at_once, str(tmp_path))
    assert P.read_profiles(spark, str(tmp_path), "data").select("load_id").distinct().count() == 3


def test_the_merged_report_profiles_all_loads_in_one_pass(spark, monkeypatch):
    from ledgerlake.plans import queries
    saved, save = [], P.save_profile
    monkeypatch.setattr(P, "save_profile", lambda states, path: saved.append(states) or save(states, path))
    queries.RAW_QUERIES["merged_quality_report"](spark, SF)
    assert len(saved) == 1 and saved[0].select("load_id").distinct().count() == 4
