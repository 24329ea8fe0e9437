"""Mergeable quality profiles: a report over all loads without reading the rows of old ones.

A load's profile is one aggregate over its rows, kept in long form: counts (rows, nulls, non-positive values, dates that
do not parse) and a HyperLogLog sketch of its keys, or of its whole rows. Profiles of loads are merged by adding the
counts and uniting the sketches, so a report over any number of loads reads a few rows a load. Its counts are those of a
report over all rows (:mod:`ledgerlake.operators.quality`, which stays the default); the numbers of different keys and of
duplicates are estimates, with a relative standard error of the different keys of 1.04 / sqrt(2**SKETCH_BITS) (0.8 %).

    dataset STRING, load_id STRING, metric STRING, column_name STRING, value BIGINT, sketch BINARY
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.entities import EntitySpec
from ledgerlake.functions.columns import col, comparable

SKETCH_BITS = 14
STANDARD_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)
KEYS, ROWS = "unique_keys", "unique_rows"


def _hash(df: DataFrame, names: list[str]) -> Column:
    """A row's hash over columns; a null is a value of its own."""
    return F.xxhash64(*[x for n in names for x in (comparable(df, n), col(n).isNull())])


def profile_state(df: DataFrame, dataset: str, load_id: str, entity: EntitySpec | None = None) -> DataFrame:
    """The profile of one load, in one pass: that of an entity's report, or of the generic one."""
    return profile_states(df, dataset, {load_id: F.lit(True)}, entity)


def profile_states(df: DataFrame, dataset: str, loads: dict[str, Column], entity: EntitySpec | None = None) -> DataFrame:
    """The profiles of several loads, in one pass over all their rows.

    ``loads``: load id to whether a row is part of the load. The profiles are those of :func:`profile_state` over the
    rows of each, also if there are none.
    """
    names = list(df.columns) if entity is None else [c for c in entity.columns if c in df.columns]
    found: list[tuple[str, str | None, Column]] = [("row_count", None, F.lit(True))]  # rows that count
    found += [("null_count", c, col(c).isNull()) for c in names]
    said: list[tuple[str, str | None]] = []
    hashed, of = names, ROWS
    if entity is not None:
        said += [("missing_column", c) for c in entity.columns if c not in df.columns]
        said += [("unexpected_column", c) for c in df.columns if c not in entity.columns]
        found += [("invalid_count", c, col(c) <= 0) for c in entity.positive if c in names]
        dates = {f.name for f in entity.schema.fields if isinstance(f.dataType, T.DateType)}
        found += [("unparsable_date", c, col(c).isNotNull() & F.try_to_date(col(c)).isNull())
                  for c in names if c in dates and isinstance(df.schema[c].dataType, T.StringType)]
        hashed, of = [c for c in entity.key if c in names], KEYS
    marked = df.select("*", *[inside.alias(f"__load{n}") for n, inside in enumerate(loads.values())])
    totals = []
    for n in range(len(loads)):
        inside = F.col(f"__load{n}")
        totals += [F.count_if(inside & c).alias(f"m{n}_{k}") for k, (_, _, c) in enumerate(found)]
        if hashed:
            totals.append(F.hll_sketch_agg(F.when(inside, _hash(df, hashed)), F.lit(SKETCH_BITS)).alias(f"s{n}"))
    one = marked.agg(*totals)

    def state(load_id: str, metric: str, name: str | None, value: Column, sketch: Column | None = None) -> Column:
        return F.struct(F.lit(metric).alias("metric"), F.lit(name).cast("string").alias("column_name"),
                        value.cast("long").alias("value"),
                        (F.lit(None) if sketch is None else sketch).cast("binary").alias("sketch"),
                        F.lit(load_id).alias("load_id"))
    rows = []
    for n, load_id in enumerate(loads):
        rows += [state(load_id, metric, name, F.col(f"m{n}_{k}")) for k, (metric, name, _) in enumerate(found)]
        rows += [state(load_id, metric, name, F.lit(1)) for metric, name in said]
        rows += [state(load_id, of, ",".join(hashed) if of == KEYS else None, F.lit(None), F.col(f"s{n}"))] if hashed else []
    return one.select(F.inline(F.array(*rows))).select(
        F.lit(dataset).alias("dataset"), "load_id", "metric", "column_name", "value", "sketch")


def save_profile(state: DataFrame, path: str) -> None:
    """Adds profiles of loads to those under ``path``; the same load again replaces its own."""
    (state.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dataset", "load_id")
     .parquet(path))


def read_profiles(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    schema = "metric string, column_name string, value long, sketch binary, dataset string, load_id string"
    return spark.read.schema(schema).parquet(path).filter(F.col("dataset") == dataset)


def merged(states: DataFrame) -> DataFrame:
    """One profile of all loads, in the form of one: (dataset, metric, column_name, value, sketch)."""
    return states.groupBy("dataset", "metric", "column_name").agg(
        F.sum("value").alias("value"), F.expr("hll_union_agg(sketch) FILTER (WHERE sketch IS NOT NULL)").alias("sketch"))


def merged_report(states: DataFrame) -> DataFrame:
    """The report over the loads of one dataset's ``states``: dataset, check_name, column_name, value, passed, exact.

    Of an entity's profiles the rows of :func:`ledgerlake.operators.quality.entity_quality_report`, of others those of
    the generic report without its column count. Nulls of the generic report are for information, as there.
    """
    one = merged(states).withColumn("unique", F.when(F.col("sketch").isNotNull(), F.hll_sketch_estimate("sketch")))
    metric, name, value = F.col("metric"), F.col("column_name"), F.col("value")
    totals = one.groupBy("dataset").agg(
        F.max(F.when(metric == "row_count", value)).alias("rows"),
        F.bool_or(metric.isin(KEYS, "missing_column", "unexpected_column")).alias("typed"),
        F.sum(F.when(metric == "null_count", value)).alias("nulls"),
        F.sum(F.when(metric == "invalid_count", value)).alias("invalid"),
        F.count_if(metric == "missing_column").cast("long").alias("missing"))
    one = one.join(totals.select("dataset", "rows", "typed"), "dataset")  # one row a dataset

    def row(check: Column | str, column: Column | None, number: Column, passed: Column, exact: bool = True) -> Column:
        return F.struct((F.lit(check) if isinstance(check, str) else check).alias("check_name"),
                        (F.lit(None).cast("string") if column is None else column).alias("column_name"),
                        number.cast("long").alias("value"), passed.alias("passed"), F.lit(exact).alias("exact"))
    fewer = F.greatest(F.col("rows") - F.col("unique"), F.lit(0))
    checks = (F.when(metric == KEYS, F.array(row(KEYS, name, F.col("unique"), F.lit(True), False),
                                             row("duplicate_count", name, fewer, fewer == 0, False)))
              .when(metric == ROWS, F.array(row("duplicate_rows", None, fewer, fewer == 0, False)))
              .when(metric.isin("missing_column", "unexpected_column"),
                    F.array(row(metric, name, F.lit(1), metric == "unexpected_column")))
              .when(metric == "row_count", F.array(row(metric, name, value, F.lit(True))))
              .when(metric == "null_count", F.array(row(metric, name, value, ~F.col("typed") | (value == 0))))
              .otherwise(F.array(row(metric, name, value, value == 0))))
    each = one.select("dataset", F.inline(checks))
    none = F.array().cast(f"array<{_ROW}>")
    summary = F.concat(
        F.array(row("nulls", None, F.coalesce("nulls", F.lit(0)), ~F.col("typed") | (F.coalesce("nulls", F.lit(0)) == 0))),
        F.when(F.col("typed"), F.array(row("schema", None, F.col("missing"), F.col("missing") == 0))).otherwise(none),
        F.when(F.col("invalid").isNotNull(), F.array(row("positive_values", None, F.col("invalid"), F.col("invalid") == 0)))
        .otherwise(none))
    return each.unionByName(totals.select("dataset", F.inline(summary)))


_ROW = "struct<check_name:string,column_name:string,value:bigint,passed:boolean,exact:boolean>"

