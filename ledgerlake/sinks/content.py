"""What a table holds, as numbers that do not depend on the order of rows, and the comparison of these numbers.

A fingerprint is the number of rows and, for each of two independent 64-bit row hashes, their sum modulo 2**64. Sums are
the same for every order and every division into files, and differ when a value, a pair of columns or the number of times
that a row occurs differs (but for chance of some 2**-128 for changes that do not aim at it). A row's hash takes its
columns in order of their names, each with whether it is null. The sums are taken in parts of 21 bits, so that they are
exact for any number of rows below 2**42.

A load takes the fingerprint of the rows that it writes as metrics of the write (``observe``), and records it with the
columns and layout as a table property. :func:`reconcile` reads the table and compares.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.columns import comparable, quote
from ledgerlake.sinks import warehouse as W

_BITS, _PARTS = 21, 4


def metrics(df: DataFrame, names: list[str], keep: Column | None = None) -> list[Column]:
    """Aggregates of the columns ``names`` of ``df`` from which :func:`fingerprint` makes a fingerprint; of the rows for
    which ``keep`` holds."""
    values = [x for n in sorted(names) for x in (comparable(df, n), comparable(df, n).isNull())]
    out = [F.count(F.when(keep, F.lit(1)) if keep is not None else F.lit(1)).alias("fp_rows")]
    for seed in range(2):
        row = F.xxhash64(F.lit(f"row hash {seed}"), *values)
        for k in range(_PARTS):
            part = F.shiftrightunsigned(row, _BITS * k).bitwiseAND(F.lit((1 << _BITS) - 1))
            out.append(F.sum(F.when(keep, part) if keep is not None else part).alias(f"fp_{seed}_{k}"))
    return out


def fingerprint(found: dict) -> str:
    """``rows:sum:sum`` of the values of :func:`metrics`."""
    sums = [sum((found[f"fp_{seed}_{k}"] or 0) << _BITS * k for k in range(_PARTS)) % 2**64 for seed in range(2)]
    return ":".join(map(str, [found["fp_rows"], *sums]))


def record(rows: DataFrame, partition_by: list[str], clustering: list[str], content: str) -> str:
    """What a load says about its table, as JSON."""
    columns = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return json.dumps({"columns": columns, "partition_by": partition_by, "clustering": clustering, "content": content},
                      sort_keys=True)


def recorded(spark: SparkSession, table: str) -> dict | None:
    """What the last load of a table recorded, or None. For a versioned table: that of its current version."""
    rows = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quote(table)}").collect()}
    text = rows.get(W.RECORD_PROPERTY)
    if text is None and "ledgerlake.version" in rows:
        return recorded(spark, f"{table}__v{int(rows['ledgerlake.version']):06}")
    return json.loads(text) if text else None


SCHEMA = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("check_name", T.StringType()),
                       T.StructField("expected", T.StringType()), T.StructField("actual", T.StringType()),
                       T.StructField("matches", T.BooleanType())])


def _described(spark: SparkSession, table: str, expected: dict) -> dict[str, str]:
    df = spark.table(table)
    columns = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    layout = W.table_layout(spark, table) or {}
    if not layout.get("partition_by"):  # a view: the layout is that of the table below
        version = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quote(table)}").collect()}.get(
            "ledgerlake.version")
        layout = (W.table_layout(spark, f"{table}__v{int(version):06}") if version else layout) or {}
    hashed = [n for n in expected.get("columns", columns) if n in columns and n not in expected.get("partition_by", [])]
    content = fingerprint(df.agg(*metrics(df, hashed)).first().asDict())
    return {"columns": json.dumps(columns, sort_keys=True), "partition_by": json.dumps(layout.get("partition_by", [])),
            "clustering": json.dumps(layout.get("clustering", [])), "row_count": content.split(":")[0],
            "content": content.split(":", 1)[1]}


def reconcile(spark: SparkSession, tables: list[str]) -> DataFrame:
    """table_name, check_name (columns with their types, partition_by, clustering, row_count, content), expected (as
    recorded by the last load), actual, matches; a table that is missing or has no record matches in nothing.

    One scan of each table's columns; what is collected is one row a table.
    """
    found = []
    for t in tables:
        expected = recorded(spark, t) if spark.catalog.tableExists(t) else None
        if expected is None:
            found.append((t, "recorded", "a load's record", None, False))
            continue
        actual = _described(spark, t, expected)
        said = {"columns": json.dumps(expected["columns"], sort_keys=True),
                "partition_by": json.dumps(expected["partition_by"]), "clustering": json.dumps(expected["clustering"]),
                "row_count": expected["content"].split(":")[0], "content": expected["content"].split(":", 1)[1]}
        found += [(t, check, said[check], actual[check], said[check] == actual[check]) for check in said]
    return spark.createDataFrame(found, SCHEMA)
