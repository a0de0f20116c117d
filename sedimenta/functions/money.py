"""Exact money arithmetic.

A sum of doubles depends on the order in which tasks deliver their rows, so amounts are summed as
decimals and turned back into doubles only in the last projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(14,2)"
TOTAL = "decimal(28,2)"
RATE = "decimal(4,2)"
QUANTITY = "decimal(5,0)"


def money(col: Column | str) -> Column:
    return _col(col).cast(MONEY)


def sum_money(col: Column | str) -> Column:
    """Exact sum of a money expression, as a double."""
    return F.sum(money(col)).cast("double")


def sum_exact(col: Column | str) -> Column:
    """Exact sum of an expression that is a decimal already, as a double."""
    return F.sum(_col(col)).cast("double")


def sum_totals(col: Column | str) -> Column:
    """Exact sum of amounts that are sums themselves, up to 10**26 each, as a double."""
    return F.sum(_col(col).cast(TOTAL)).cast("double")


def ratio(total: Column, count: Column) -> Column:
    """Quotient of two exact aggregates, computed once in double precision."""
    return total.cast("double") / count.cast("double")


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
