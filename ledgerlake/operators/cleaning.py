"""Cleaning: generic (any schema) and typed (customers, orders, products).

All cleaners are single projections / filters / one aggregate, so Catalyst fuses
them into the scan's codegen stage; none of them collects data.

Key de-duplication keeps one row per key. The survivor is made deterministic by
taking the smallest row in a fixed column order, computed as ``min(struct(...))``
per key: the aggregate runs partially on the map side, so a key that holds a third
of all rows is reduced inside each input task before the shuffle, and no group is
ever gathered into one task (unlike ``row_number`` over a window, which sorts every
row of a hot key in a single task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.entities import EntitySpec
from ledgerlake.functions.naming import normalize_columns
from ledgerlake.functions.columns import col as _c
from ledgerlake.functions.columns import has_map


def clean_strings(df: DataFrame) -> DataFrame:
    """Trim every top-level string column and turn ``""`` into NULL (one projection)."""
    cols = [
        F.nullif(F.trim(_c(f.name)), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType)
        else _c(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct (NULLs compare equal). Map columns, which Spark cannot
    compare, are turned into JSON text first."""
    cols = [F.to_json(_c(f.name)).alias(f.name) if has_map(f.dataType) else _c(f.name)
            for f in df.schema.fields]
    return df.select(*cols).dropDuplicates()


def clean_dataframe(df: DataFrame) -> DataFrame:
    """Generic cleaning for any schema: normalise names, trim / empty -> NULL on
    strings, drop whole-row duplicates."""
    return drop_duplicate_rows(clean_strings(normalize_columns(df)))


def dedupe_by_key(df: DataFrame, keys: list[str] | tuple[str, ...], order_by: list[str] | None = None,
                  deterministic: bool = True) -> DataFrame:
    """One row per key.

    ``deterministic=True``: the survivor is the row that sorts first by ``order_by``
    (default: all non-key columns in schema order), ascending with NULLs first, the
    remaining columns breaking ties. ``deterministic=False``: ``dropDuplicates(keys)``,
    any survivor (cheaper hash aggregate).
    """
    keys = list(keys)
    if not deterministic:
        return df.dropDuplicates(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*[_c(k) for k in keys]).dropDuplicates()
    order = [c for c in (order_by or rest) if c in rest]
    order += [c for c in rest if c not in order]
    fields = {c: f"f{i}" for i, c in enumerate(order)}
    row = F.struct(*[_c(c).alias(fields[c]) for c in order])
    maps = [c for c in order if has_map(df.schema[c].dataType)]
    if maps:
        # maps cannot be compared: order by their JSON text, carry the values unchanged
        ordering = F.struct(*[(F.to_json(_c(c)) if c in maps else _c(c)).alias(fields[c]) for c in order])
        best = F.min_by(row, ordering).alias("_best")
    else:
        best = F.min(row).alias("_best")
    picked = df.groupBy(*[_c(k) for k in keys]).agg(best)
    return picked.select(*[
        _c(c) if c in keys else F.col(f"_best.{fields[c]}").alias(c) for c in df.columns
    ])


def _as_date(df: DataFrame, name: str) -> Column:
    """A DATE from a date, timestamp or text column; unparsable text -> NULL."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.DateType):
        return _c(name)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return _c(name).cast("date")
    return F.try_to_date(_c(name).cast("string"))


def clean_customers(df: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """One row per customer_id (chosen before trimming), then trimmed name / city /
    country, lower-cased trimmed e-mail and a DATE signup_date."""
    deduped = dedupe_by_key(df, ["customer_id"], order_by)
    fix = {
        "name": F.trim(F.col("name")),
        "email": F.lower(F.trim(F.col("email"))),
        "city": F.trim(F.col("city")),
        "country": F.trim(F.col("country")),
        "signup_date": _as_date(deduped, "signup_date"),
    }
    return deduped.select(*[fix[c].alias(c) if c in fix else _c(c) for c in deduped.columns])


def valid_order_condition() -> Column:
    """``quantity > 0 AND price > 0``; a NULL in either fails."""
    return (F.col("quantity") > 0) & (F.col("price") > 0)


def clean_orders(df: DataFrame, key: list[str] | tuple[str, ...] = ("order_id",),
                 order_by: list[str] | None = None) -> DataFrame:
    """DATE order_date (unparsable -> NULL), keep quantity > 0 and price > 0, then
    one row per key. Filters sit on raw columns so they reach the parquet scan."""
    typed = df.select(*[_as_date(df, c).alias(c) if c == "order_date" else _c(c) for c in df.columns])
    return dedupe_by_key(typed.filter(F.col("quantity") > 0).filter(F.col("price") > 0), list(key), order_by)


def reject_orders(df: DataFrame) -> DataFrame:
    """Quarantine view of the order filters (extension: the cleaner drops these rows
    silently): every row that ``clean_orders`` filters out, with ``reject_reason``,
    a comma-separated list of quantity_missing / quantity_not_positive /
    price_missing / price_not_positive."""
    q, p = F.col("quantity"), F.col("price")
    reason = F.concat_ws(
        ",",
        F.when(q.isNull(), F.lit("quantity_missing")),
        F.when(q <= 0, F.lit("quantity_not_positive")),
        F.when(p.isNull(), F.lit("price_missing")),
        F.when(p <= 0, F.lit("price_not_positive")),
    )
    return df.filter(~F.coalesce(valid_order_condition(), F.lit(False))).select("*", reason.alias("reject_reason"))


def clean_products(df: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """Trimmed product_name and category, then one row per product_id."""
    fix = {"product_name": F.trim(F.col("product_name")), "category": F.trim(F.col("category"))}
    trimmed = df.select(*[fix[c].alias(c) if c in fix else _c(c) for c in df.columns])
    return dedupe_by_key(trimmed, ["product_id"], order_by)


def cast_to_entity(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """Cast the entity's columns to its schema types (``try_cast``: bad -> NULL);
    dates go through :func:`_as_date`; other columns are kept as they are."""
    types = {f.name: f.dataType for f in spec.schema.fields}
    cols = []
    for c in df.columns:
        if c not in types:
            cols.append(_c(c))
        elif isinstance(types[c], T.DateType):
            cols.append(_as_date(df, c).alias(c))
        else:
            cols.append(_c(c).try_cast(types[c]).alias(c))
    return df.select(*cols)
