"""Reconciliation of content and layout: what differs is found, what only looks different is not."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlake.sinks import content as K
from ledgerlake.sinks import versions as V
from ledgerlake.sinks import warehouse as W


def mark(df):
    return K.fingerprint(df.agg(*K.metrics(df, df.columns)).first().asDict())


def base(spark):
    return spark.createDataFrame([(1, "x", None, 1.5, [1, 2]), (2, None, "x", 2.5, []), (3, "y", "z", None, None),
                                  (3, "y", "z", None, None), (4, "", "q", 0.0, [None])],
                                 "k int, a string, b string, d double, l array<int>")


def test_order_and_files_do_not_matter(spark):
    df = base(spark)
    want = mark(df)
    assert mark(df.orderBy(F.desc("k")).repartition(3)) == want == mark(df.select("l", "b", "k", "d", "a").coalesce(1))
    assert want.startswith("5:")


@pytest.mark.parametrize("change", [
    lambda df: df.withColumn("a", F.when(F.col("k") == 1, F.lit("w")).otherwise(F.col("a"))),
    lambda df: df.withColumns({"a": F.col("b"), "b": F.col("a")}),
    lambda df: df.withColumn("a", F.coalesce("a", F.lit(""))),
    lambda df: df.filter("k <> 4").unionByName(df.filter("k = 1")),  # one row lost, one repeated
    lambda df: df.distinct().unionByName(df.filter("k = 2")),
    lambda df: df.filter("k < 4"),
    lambda df: df.withColumn("l", F.when(F.col("k") == 2, F.lit(None)).otherwise(F.col("l"))),
])
def test_changes_are_found(spark, change):
    assert mark(change(base(spark))) != mark(base(spark))


def test_maps_and_empty_tables(spark):
    df = spark.createDataFrame([({"a": 1},), ({},), (None,)], "m map<string,int>")
    assert mark(df) == mark(df.repartition(2)) != mark(df.limit(2))
    assert mark(df.limit(0)) == "0:0:0"


def found(spark, table):
    return {r["check_name"]: r["matches"] for r in K.reconcile(spark, [table]).collect()}


@pytest.mark.parametrize("load", [W.load_table, V.load_version], ids=["plain", "versioned"])
def test_a_loaded_table(spark, tmp_path, typed_tables, load):
    table = f"content_{load.__name__}"
    done = load(spark, typed_tables["customers"], table, str(tmp_path), num_files=2)
    checks = ["columns", "partition_by", "clustering", "row_count", "content"]
    assert found(spark, table) == dict.fromkeys(checks, True)
    again = load(spark, typed_tables["customers"].limit(3), table, str(tmp_path))
    assert found(spark, table) == dict.fromkeys(checks, True) and again["rows_loaded"] == 3
    files = spark.read.parquet(again["location"])
    other = files.withColumn("city", F.lit("elsewhere")).collect()  # below the catalog
    spark.createDataFrame(other, files.schema).write.mode("overwrite").partitionBy(W.INGEST_DATE).parquet(again["location"])
    below = V.version_table(table, 2) if load is V.load_version else table
    spark.catalog.refreshTable(below)
    spark.catalog.refreshTable(table)
    assert found(spark, table) == {**dict.fromkeys(checks, True), "content": False}
    spark.sql(f"ALTER TABLE {below} SET TBLPROPERTIES ('{W.CLUSTERING_PROPERTY}' = 'email')")
    assert not found(spark, table)["clustering"] and done["created"]


def test_columns_and_tables_without_a_record(spark, tmp_path):
    W.load_table(spark, spark.range(3).selectExpr("id AS a", "id AS b"), "content_cols", str(tmp_path))
    kept = K.recorded(spark, "content_cols")
    W.load_table(spark, spark.range(3).selectExpr("id AS a", "CAST(id AS string) AS b"), "content_cols", str(tmp_path))
    assert kept["columns"]["b"] == "bigint" and K.recorded(spark, "content_cols")["columns"]["b"] == "string"
    spark.range(2).write.mode("overwrite").saveAsTable("content_foreign")
    rows = [tuple(r) for r in K.reconcile(spark, ["content_foreign", "content_nowhere"]).collect()]
    assert [(r[0], r[1], r[4]) for r in rows] == [("content_foreign", "recorded", False), ("content_nowhere", "recorded", False)]


def test_rejects_are_no_content(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (None, "bad"), (2, None)], "a int, bad string")
    W.load_table(spark, df, "content_rejects", str(tmp_path), reject="bad", max_rejects=1)
    assert all(found(spark, "content_rejects").values())
    assert K.recorded(spark, "content_rejects")["content"] == mark(df.filter("bad IS NULL").select("a"))
