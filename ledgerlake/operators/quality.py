"""Data-quality checks as one-pass, long-form report DataFrames.

Every check contributes metrics to a single ``agg`` over the input, so a whole
report (row count, per-column null counts, non-positive counts, duplicate keys or
duplicate rows) is one scan and one action, instead of one job per column. The
one-row result is turned into long form with one ``stack``:

    dataset STRING, check_name STRING, column_name STRING, value BIGINT, passed BOOLEAN

Schema checks (required / unexpected columns) use only ``df.columns`` and are
added as literal rows of the same report.

Check rows:

* ``row_count``                       rows, always passed
* ``schema``                          missing required columns (typed: passed iff 0);
                                      generic report: column count, passed iff > 0
* ``missing_column`` / ``unexpected_column``   one row per name (value 1)
* ``null_count`` per column, ``nulls`` total   passed iff 0 (typed) / always (generic)
* ``unique_keys``, ``duplicate_count``         key duplicates = rows - distinct keys,
                                      NULL keys form a group of their own
* ``duplicate_rows``                  rows - distinct whole rows
* ``invalid_count`` per column, ``positive_values`` total   rows with value <= 0
                                      (NULL is not invalid)
* ``unparsable_date`` per column      typed reports, date columns arriving as text:
                                      non-NULL values that do not parse as a date
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.entities import CUSTOMERS, ORDERS, PRODUCTS, EntitySpec
from ledgerlake.functions.columns import col as _c
from ledgerlake.functions.columns import comparable as _comparable

REPORT_COLUMNS = ("dataset", "check_name", "column_name", "value", "passed")


@dataclass
class _Row:
    check: str
    column: str | None
    value: str   # SQL over the aggregated row (metric names _m0, _m1, ...)
    passed: str  # SQL boolean over the aggregated row


def _sql_text(v: str | None) -> str:
    """A SQL string literal (or NULL)."""
    if v is None:
        return "CAST(NULL AS STRING)"
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


class ReportBuilder:
    """Collects metrics for one dataset and emits them as one aggregate.

    Metrics are aggregate Columns over the input; report rows are small SQL
    expressions over the one aggregated row (``_m0 = 0``, ``_m0 - _m1``), unpivoted
    by a single ``stack``.
    """

    def __init__(self, df: DataFrame, dataset: str, copies: str | None = None):
        """``copies``: a column of ``df`` with the number of input rows that each of its rows stands for."""
        self.df = df
        self.dataset = dataset
        self.copies = copies
        self._aggs: list[Column] = []
        self._rows: list[_Row] = []

    def metric(self, agg: Column) -> str:
        """Register an aggregate; returns the name of its (one-row) result."""
        name = f"_m{len(self._aggs)}"
        self._aggs.append(agg.alias(name))
        return name

    def row(self, check: str, column: str | None, value: str, passed: str | bool) -> None:
        p = ("true" if passed else "false") if isinstance(passed, bool) else passed
        self._rows.append(_Row(check, column, value, p))

    # --- checks ---------------------------------------------------------------

    def count_if(self, condition: Column) -> Column:
        """The aggregate that counts the input rows where ``condition`` holds."""
        return F.count_if(condition) if self.copies is None else F.sum(F.when(condition, F.col(self.copies)))

    def row_count(self) -> str:
        n = self.metric(F.count(F.lit(1)) if self.copies is None else F.coalesce(F.sum(self.copies), F.lit(0)))
        self.row("row_count", None, n, True)
        return n

    def required_columns(self, required: tuple[str, ...] | list[str]) -> list[str]:
        present = set(self.df.columns)
        missing = sorted(set(required) - present)
        unexpected = sorted(present - set(required))
        self.row("schema", None, str(len(missing)), len(missing) == 0)
        for name in missing:
            self.row("missing_column", name, "1", False)
        for name in unexpected:
            self.row("unexpected_column", name, "1", True)
        return [c for c in required if c in present]

    def nulls(self, columns: list[str], informational: bool = False) -> None:
        counts = [self.metric(F.coalesce(self.count_if(_c(c).isNull()), F.lit(0))) for c in columns]
        for name, n in zip(columns, counts):
            self.row("null_count", name, n, True if informational else f"{n} = 0")
        total = f"({' + '.join(counts)})" if counts else "0"
        self.row("nulls", None, total, True if informational else f"{total} = 0")

    def duplicate_keys(self, keys: list[str], total: str) -> None:
        label = ",".join(keys)
        unique = self.metric(F.count_distinct(F.struct(*[_comparable(self.df, k) for k in keys])))
        self.row("unique_keys", label, unique, True)
        self.row("duplicate_count", label, f"({total} - {unique})", f"{total} - {unique} = 0")

    def duplicate_rows(self, total: str, row_key: str = "exact") -> None:
        """Whole-row duplicates. ``row_key="exact"`` counts distinct rows (every row
        crosses the shuffle); ``"hash128"`` counts distinct pairs of independent
        64-bit row hashes, so 16 bytes per row cross it. Two different rows collide
        with probability about n^2 / 2^129 (1e-15 for 10^12 rows)."""
        if not self.df.columns:
            self.row("duplicate_rows", None, "0", True)
            return
        if self.copies is not None:  # the rows are distinct already
            unique = self.metric(F.count(F.lit(1)))
            self.row("duplicate_rows", None, f"({total} - {unique})", f"{total} - {unique} = 0")
            return
        cols = [_comparable(self.df, c) for c in self.df.columns]
        if row_key == "hash128":
            # NULL and the empty string hash alike, so each value is tagged with its null-ness
            tagged = [x for c in cols for x in (c.isNull(), c)]
            key = F.struct(F.xxhash64(*tagged), F.xxhash64(F.lit("ledgerlake"), *tagged))
        elif row_key == "exact":
            key = F.struct(*cols)
        else:
            raise ValueError(f"row_key must be 'exact' or 'hash128', not {row_key!r}")
        unique = self.metric(F.count_distinct(key))
        self.row("duplicate_rows", None, f"({total} - {unique})", f"{total} - {unique} = 0")

    def positive(self, columns: list[str]) -> None:
        counts = [self.metric(F.count_if(_c(c) <= 0)) for c in columns]
        for name, n in zip(columns, counts):
            self.row("invalid_count", name, n, f"{n} = 0")
        total = f"({' + '.join(counts)})" if counts else "0"
        self.row("positive_values", None, total, f"{total} = 0")

    def unparsable_dates(self, columns: list[str]) -> None:
        for name in columns:
            text = _c(name).cast("string")
            n = self.metric(F.count_if(text.isNotNull() & F.try_to_date(text).isNull()))
            self.row("unparsable_date", name, n, f"{n} = 0")

    # --- output ---------------------------------------------------------------

    def build(self) -> DataFrame:
        """One aggregate over the input, then the report rows by one ``stack``."""
        aggs = self._aggs or [F.count(F.lit(1)).alias("_m0")]
        one = self.df.agg(*aggs)
        values = ", ".join(
            f"{_sql_text(self.dataset)}, {_sql_text(r.check)}, {_sql_text(r.column)}, "
            f"COALESCE(CAST({r.value} AS BIGINT), 0L), CAST({r.passed} AS BOOLEAN)"
            for r in self._rows
        )
        return one.selectExpr(
            f"stack({len(self._rows)}, {values}) AS ({', '.join(REPORT_COLUMNS)})")


# --- public checks (each a one-pass report DataFrame) ------------------------

def check_nulls(df: DataFrame, columns: list[str], dataset: str = "dataset") -> DataFrame:
    """Null count per column plus a total; passed iff no NULLs."""
    b = ReportBuilder(df, dataset)
    b.nulls(list(columns))
    return b.build()


def check_duplicates(df: DataFrame, key_columns: list[str], dataset: str = "dataset") -> DataFrame:
    """total_rows, unique_keys and duplicate_count = rows - distinct keys."""
    b = ReportBuilder(df, dataset)
    total = b.metric(F.count(F.lit(1)))
    b.row("total_rows", None, total, True)
    b.duplicate_keys(list(key_columns), total)
    return b.build()


def check_positive_values(df: DataFrame, columns: list[str], dataset: str = "dataset") -> DataFrame:
    """Rows with value <= 0 per column plus a total; passed iff none."""
    b = ReportBuilder(df, dataset)
    b.positive(list(columns))
    return b.build()


def check_required_columns(df: DataFrame, required: list[str], dataset: str = "dataset") -> DataFrame:
    """Missing / unexpected columns (sorted); passed iff none missing. With the
    row count, so the report is computed from the data like every other report."""
    b = ReportBuilder(df, dataset)
    b.row_count()
    b.required_columns(required)
    return b.build()


def generate_quality_report(df: DataFrame, dataset: str, row_key: str = "exact") -> DataFrame:
    """Generic report for any schema: row and column counts, null counts
    (informational) and whole-row duplicates. ``row_key``: see
    :meth:`ReportBuilder.duplicate_rows`.

    With ``"exact"`` the rows are grouped by their plain columns with a count, and all
    figures are sums over the groups: one shuffle of whole rows, none if ``df`` is
    distributed by all its columns already, as after a DISTINCT."""
    columns = list(df.columns)
    n_cols = len(columns)
    if row_key == "exact" and columns:
        copies = "_copies"
        while copies in columns:
            copies = "_" + copies
        rows = df.groupBy(*[_comparable(df, c).alias(c) for c in columns]).agg(F.count(F.lit(1)).alias(copies))
        b = ReportBuilder(rows, dataset, copies)
    else:
        b = ReportBuilder(df, dataset)
    total = b.row_count()
    b.row("column_count", None, str(n_cols), True)
    b.row("schema", None, str(n_cols), n_cols > 0)
    b.nulls(columns, informational=True)
    b.duplicate_rows(total, row_key)
    return b.build()


def entity_quality_report(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """Typed report for an entity: schema, nulls, key duplicates and, where the
    entity has them, non-positive values — one aggregate."""
    b = ReportBuilder(df, spec.name)
    total = b.row_count()
    present = b.required_columns(spec.columns)
    b.nulls(present)
    keys = [k for k in spec.key if k in present]
    if keys:
        b.duplicate_keys(keys, total)
    positive = [c for c in spec.positive if c in present]
    if positive:
        b.positive(positive)
    date_cols = {f.name for f in spec.schema.fields if isinstance(f.dataType, T.DateType)}
    text_dates = [f.name for f in df.schema.fields if f.name in date_cols and isinstance(f.dataType, T.StringType)]
    if text_dates:
        b.unparsable_dates(text_dates)
    return b.build()


def generate_customer_quality_report(df: DataFrame) -> DataFrame:
    """Typed report for customers (6 required columns, key customer_id)."""
    return entity_quality_report(df, CUSTOMERS)


def generate_order_quality_report(df: DataFrame) -> DataFrame:
    """Typed report for orders (6 required columns, key order_id, quantity and price > 0)."""
    return entity_quality_report(df, ORDERS)


def generate_product_quality_report(df: DataFrame) -> DataFrame:
    """Typed report for products (3 required columns, key product_id)."""
    return entity_quality_report(df, PRODUCTS)


def quality_before_after(raw: DataFrame, cleaned: DataFrame, dataset: str) -> DataFrame:
    """Generic report on the raw and the cleaned data of one run, with a ``stage``."""
    before = generate_quality_report(raw, dataset).select(F.lit("raw").alias("stage"), "*")
    after = generate_quality_report(cleaned, dataset).select(F.lit("processed").alias("stage"), "*")
    return before.unionByName(after)


def report_as_dict(report: DataFrame) -> dict:
    """Nested dict view of a (small, bounded) report: ``{check: {...}}``.

    The report has a fixed number of rows per column of the input, so collecting
    it is safe; the data itself never reaches the driver.
    """
    rows = report.collect()
    out: dict = {"dataset": rows[0]["dataset"] if rows else None}
    nulls: dict = {}
    invalid: dict = {}
    for r in rows:
        check, col, value, passed = r["check_name"], r["column_name"], r["value"], r["passed"]
        if check == "row_count":
            out["row_count"] = value
        elif check == "column_count":
            out["column_count"] = value
        elif check == "schema":
            if "column_count" in out:  # generic report: passed iff the dataset has columns
                out["schema"] = {"passed": passed, "column_count": value}
            else:
                out.setdefault("schema", {}).update(passed=passed, missing_count=value)
        elif check == "missing_column":
            out.setdefault("schema", {}).setdefault("missing_columns", []).append(col)
        elif check == "unexpected_column":
            out.setdefault("schema", {}).setdefault("unexpected_columns", []).append(col)
        elif check == "null_count":
            nulls[col] = value
        elif check == "nulls":
            out["nulls"] = {"passed": passed, "total_nulls": value, "null_counts": nulls}
        elif check == "total_rows":
            out.setdefault("duplicates", {})["total_rows"] = value
        elif check == "unique_keys":
            out.setdefault("duplicates", {})["unique_rows"] = value
        elif check == "duplicate_count":
            out.setdefault("duplicates", {}).update(passed=passed, duplicate_count=value)
        elif check == "duplicate_rows":
            out["duplicates"] = {"passed": passed, "duplicate_rows": value}
        elif check == "invalid_count":
            invalid[col] = value
        elif check == "positive_values":
            out["positive_values"] = {"passed": passed, "invalid_counts": invalid}
        elif check == "unparsable_date":
            dates = out.setdefault("dates", {"passed": True, "unparsable_counts": {}})
            dates["unparsable_counts"][col] = value
            dates["passed"] = dates["passed"] and passed
    if "schema" in out and "column_count" not in out["schema"]:
        out["schema"].setdefault("missing_columns", [])
        out["schema"].setdefault("unexpected_columns", [])
    if "duplicates" in out and "unique_rows" in out["duplicates"] and "total_rows" not in out["duplicates"]:
        out["duplicates"]["total_rows"] = out.get("row_count")
    return out
