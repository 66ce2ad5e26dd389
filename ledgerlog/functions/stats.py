"""Aggregate and arithmetic expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timewin import ColumnLike, When, as_column, date_lit

MONEY = "decimal(12,2)"
MONEY_TO_SUM = "decimal(18,2)"
SMALLEST = 1e-6


def money(c: ColumnLike) -> Column:
    return as_column(c).cast(MONEY)


def count_where(cond: Column) -> Column:
    return F.count_if(cond)


def sum_where(cond: Column) -> Column:
    """Sum of 1 or 0 per row: 0 for a group without a hit, NULL only without rows."""
    return F.sum(F.when(cond, 1).otherwise(0))


def sum0(c: ColumnLike) -> Column:
    return F.sum(F.coalesce(as_column(c), F.lit(0)))


def exact_avg(c: ColumnLike, fixed: str = "decimal(28,10)") -> Column:
    """Average over a fixed-point sum.

    A floating-point sum depends on the order in which partial results arrive, so
    a retried task can change its last digits. The fixed-point sum cannot. Ten decimals
    by default; columns that are fixed-point anyway name their own, narrower type.

    A group with a value that type cannot hold (NaN, infinite, too large, or below
    ``SMALLEST`` and so short of digits) takes the plain average.
    """
    c = as_column(c)
    held = c.try_cast(fixed)
    odd = c.isNotNull() & (held.isNull() | ((c != 0) & (F.abs(c) < SMALLEST)))
    exact = F.try_sum(held).cast("double") / F.nullif(F.count(c), F.lit(0)).cast("double")
    return F.coalesce(F.when(F.count_if(odd) == 0, exact), F.avg(c.cast("double")))


def int_avg(c: ColumnLike) -> Column:
    """Average of integers, truncated towards zero."""
    c = as_column(c).cast("bigint")
    return F.call_function("div", F.sum(c), F.nullif(F.count(c), F.lit(0)))


def safe_pct(num: Column, den: Column, precision: int = 5, scale: int = 1) -> Column:
    """``num`` as a percentage of ``den``; NULL for a zero base or an overflow."""
    ratio = num.cast("decimal(24,4)") * F.lit(100) / F.nullif(den, F.lit(0)).cast("decimal(24,4)")
    return ratio.try_cast(f"decimal({precision},{scale})")


def days_between(start: ColumnLike, end: ColumnLike | None = None, as_of: When | None = None) -> Column:
    """Whole days from ``start`` to ``end`` (or to ``as_of``)."""
    stop = date_lit(as_of) if end is None else as_column(end)
    return F.datediff(stop, as_column(start))


def month_of(c: ColumnLike) -> Column:
    return F.date_format(as_column(c), "yyyy-MM")


def risk_tier(claimed: Column, premium: Column) -> Column:
    return (
        F.when(claimed > premium * 2, "High Risk")
        .when(claimed > premium, "Medium Risk")
        .otherwise("Low Risk")
    )


def allocation_status(total: Column) -> Column:
    return F.when(total != 100, "NEEDS REVIEW").otherwise("OK")

