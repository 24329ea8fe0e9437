"""Exact money arithmetic.

Amounts are ``quantity * price`` with an integral quantity and a DECIMAL price, so
sums are exact decimals. Results leave as DOUBLE built from an integral number of
cents (``cents / 100``): one correctly rounded IEEE division that every engine
computes the same way, so results compare bit for bit.

Rounded means are half-up (away from zero) on the exact decimal sum, computed with
integral division, never a double rounding of an already rounded average.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTS_TYPE = "decimal(38,0)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def line_amount(quantity: str | Column = "quantity", price: str | Column = "price") -> Column:
    """``quantity * price``; NULL when either side is NULL (as in SQL)."""
    return _col(quantity) * _col(price)


def cents(total: str | Column) -> Column:
    """An exact decimal amount (scale <= 2) as whole cents, DECIMAL(38,0)."""
    return (_col(total) * F.lit(100)).cast(CENTS_TYPE)


def money(total: str | Column) -> Column:
    """An exact decimal amount as DOUBLE, i.e. ``ROUND(total, 2)`` for scale-2 input."""
    return cents(total).cast("double") / F.lit(100)


def rounded_mean(total: str, n: str) -> Column:
    """``ROUND(total / n, 2)`` half away from zero, exact; NULL when ``n`` is 0.

    ``total`` and ``n`` name already aggregated columns (an exact decimal sum and a
    count), so the expression runs once per group after the aggregation.
    """
    s = f"CAST(`{total}` * 100 AS {CENTS_TYPE})"
    # sign() is DOUBLE in Spark; keep the product integral so a mean rounding to 0 is 0.0, never -0.0
    q = f"((2 * abs({s}) + `{n}`) div (2 * `{n}`)) * CAST(sign({s}) AS BIGINT)"
    return F.expr(f"CASE WHEN `{n}` > 0 THEN CAST({q} AS DOUBLE) / 100 END")


def mean(total: str, n: str) -> Column:
    """Unrounded mean as DOUBLE: ``money(total) / n``; NULL when ``n`` is 0."""
    return F.when(F.col(n) > 0, money(total) / F.col(n))
