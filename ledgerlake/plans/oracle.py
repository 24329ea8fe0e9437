"""ANSI SQL (DuckDB dialect) twins of the registered queries.

Each statement carries the entity views it needs as CTEs over the base parquet
tables, and uses the same exact-money recipe as the Spark side: cents as an exact
integer, DOUBLE only at the end as ``cents / 100``.
"""

from __future__ import annotations

# --- entity views (same rules as ledgerlake.sources.tables) -------------------

VIEW_SQL = {
    "customers_v": """
  SELECT c_custkey AS customer_id, c_name AS name,
         concat('user', CAST(c_custkey AS VARCHAR), '@example.com') AS email,
         n_name AS city, r_name AS country,
         DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS signup_date
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "products_v": """
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category FROM part""",
    "orders_v": """
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, o_custkey AS customer_id, l_partkey AS product_id,
         CAST(o_orderdate AS DATE) AS order_date, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "orders_dirty_v": """
  SELECT order_id, line_no, customer_id, product_id,
         CASE WHEN order_id % 89 = 0 THEN 'not-a-date' ELSE CAST(order_date AS VARCHAR) END AS order_date,
         CASE WHEN product_id % 97 = 0 THEN -quantity WHEN product_id % 101 = 0 THEN CAST(NULL AS INTEGER)
              ELSE quantity END AS quantity,
         CASE WHEN customer_id % 31 = 0 THEN -price ELSE price END AS price
  FROM orders_v""",
    "customers_base_v": """
  SELECT customer_id,
         CASE WHEN customer_id % 5 = 0 THEN concat('  ', name, ' ') ELSE name END AS name,
         CASE WHEN customer_id % 11 = 0 THEN CAST(NULL AS VARCHAR) WHEN customer_id % 13 = 0 THEN '   '
              WHEN customer_id % 7 = 0 THEN concat(' ', upper(email), ' ') ELSE email END AS email,
         city, country, CAST(signup_date AS VARCHAR) AS signup_date
  FROM customers_v""",
    "customers_dirty_v": """
  SELECT * FROM customers_base_v
  UNION ALL SELECT * FROM customers_base_v WHERE customer_id % 10 = 0
  UNION ALL SELECT customer_id, concat(' ', name), email, city, country, signup_date
            FROM customers_base_v WHERE customer_id % 17 = 0""",
    "products_dirty_v": """
  SELECT product_id, CASE WHEN product_id % 3 = 0 THEN concat(' ', product_name, '  ') ELSE product_name END AS product_name,
         CASE WHEN product_id % 4 = 0 THEN concat(category, ' ') ELSE category END AS category
  FROM products_v
  UNION ALL SELECT product_id, concat('zz ', product_name),
                   CASE WHEN product_id % 4 = 0 THEN concat(category, ' ') ELSE category END
            FROM products_v WHERE product_id % 10 = 0""",
}

_DEPENDS = {
    "orders_dirty_v": ["orders_v"],
    "customers_base_v": ["customers_v"],
    "products_dirty_v": ["products_v"],
    "customers_dirty_v": ["customers_v", "customers_base_v"],
}


def with_views(*names: str) -> str:
    """A WITH clause defining the named views and what they depend on, in order."""
    ordered: list[str] = []
    for name in names:
        for dep in _DEPENDS.get(name, []) + [name]:
            if dep not in ordered:
                ordered.append(dep)
    return "WITH " + ",\n".join(f"{n} AS ({VIEW_SQL[n]}\n)" for n in ordered) + "\n"


# --- exact money fragments ----------------------------------------------------

def cents(total: str) -> str:
    """Exact decimal amount as whole cents (HUGEINT)."""
    return f"CAST(({total}) * 100 AS HUGEINT)"


def money(total: str) -> str:
    """Amount as DOUBLE built from cents, like :func:`ledgerlake.functions.money.money`."""
    return f"CAST({cents(total)} AS DOUBLE) / 100"


def rounded_mean(total: str, n: str) -> str:
    """Half-up (away from zero) mean to cents by integral division; NULL when n = 0."""
    s = cents(total)
    return f"CASE WHEN ({n}) > 0 THEN CAST(((2 * abs({s}) + ({n})) // (2 * ({n}))) * sign({s}) AS DOUBLE) / 100 END"


def mean(total: str, n: str) -> str:
    """Unrounded mean as DOUBLE; NULL when n = 0."""
    return f"CASE WHEN ({n}) > 0 THEN {money(total)} / ({n}) END"


def dates_as_text(sql: str, columns: list[str]) -> str:
    """Wrap ``sql`` so the named DATE columns come out as ISO text (CAST to VARCHAR)."""
    if not columns:
        return sql
    repl = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in columns)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS presented"


# --- long-form quality reports ------------------------------------------------

class SqlReport:
    """SQL twin of :class:`ledgerlake.operators.quality.ReportBuilder`: one aggregate
    CTE ``m`` over the source, then one UNION ALL branch per report row."""

    def __init__(self, source: str, dataset: str):
        self.source = source
        self.dataset = dataset
        self.metrics: list[str] = []
        self.rows: list[tuple[str, str | None, str, str]] = []

    def metric(self, expr: str) -> str:
        name = f"m{len(self.metrics)}"
        self.metrics.append(f"{expr} AS {name}")
        return name

    def row(self, check: str, column: str | None, value: str, passed: str) -> None:
        self.rows.append((check, column, value, passed))

    def row_count(self) -> str:
        n = self.metric("COUNT(*)")
        self.row("row_count", None, n, "TRUE")
        return n

    def required_columns(self, required, present) -> list[str]:
        missing = sorted(set(required) - set(present))
        unexpected = sorted(set(present) - set(required))
        self.row("schema", None, str(len(missing)), "TRUE" if not missing else "FALSE")
        for c in missing:
            self.row("missing_column", c, "1", "FALSE")
        for c in unexpected:
            self.row("unexpected_column", c, "1", "TRUE")
        return [c for c in required if c in present]

    def nulls(self, columns, informational=False) -> None:
        names = [self.metric(f'COUNT(*) FILTER (WHERE "{c}" IS NULL)') for c in columns]
        for c, n in zip(columns, names):
            self.row("null_count", c, n, "TRUE" if informational else f"{n} = 0")
        total = " + ".join(names) if names else "0"
        self.row("nulls", None, total, "TRUE" if informational else f"({total}) = 0")

    def _distinct(self, cols) -> str:
        return self.metric(f"(SELECT COUNT(*) FROM (SELECT DISTINCT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM {self.source}))")

    def duplicate_keys(self, keys, total) -> None:
        u = self._distinct(keys)
        label = ",".join(keys)
        self.row("unique_keys", label, u, "TRUE")
        self.row("duplicate_count", label, f"{total} - {u}", f"{total} - {u} = 0")

    def duplicate_rows(self, columns, total) -> None:
        u = self._distinct(columns)
        self.row("duplicate_rows", None, f"{total} - {u}", f"{total} - {u} = 0")

    def positive(self, columns) -> None:
        names = [self.metric(f'COUNT(*) FILTER (WHERE "{c}" <= 0)') for c in columns]
        for c, n in zip(columns, names):
            self.row("invalid_count", c, n, f"{n} = 0")
        total = " + ".join(names)
        self.row("positive_values", None, total, f"({total}) = 0")

    def unparsable_dates(self, columns) -> None:
        for c in columns:
            n = self.metric(f'COUNT(*) FILTER (WHERE "{c}" IS NOT NULL AND TRY_CAST("{c}" AS DATE) IS NULL)')
            self.row("unparsable_date", c, n, f"{n} = 0")

    def sql(self, prefix: str = "WITH ") -> str:
        """``prefix`` is the WITH clause of the views (or "WITH ")."""
        head = prefix.rstrip()
        head = head + ("," if head != "WITH" else "") + f"\nm AS (SELECT {', '.join(self.metrics)} FROM {self.source})\n"
        branches = []
        for check, column, value, passed in self.rows:
            col = "CAST(NULL AS VARCHAR)" if column is None else "'" + column.replace("'", "''") + "'"
            branches.append(
                f"SELECT '{self.dataset}' AS dataset, '{check}' AS check_name, {col} AS column_name, "
                f"CAST(COALESCE({value}, 0) AS BIGINT) AS value, CAST({passed} AS BOOLEAN) AS passed FROM m")
        return head + "\nUNION ALL\n".join(branches)
