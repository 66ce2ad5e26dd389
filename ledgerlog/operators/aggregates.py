"""Grouping operators. All of them combine on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import MONEY_TO_SUM, days_between, exact_avg, int_avg, money, month_of
from ..functions.timewin import bin_start
from .extremum import first_of
from .topk import first_per_group


def count_by(df: DataFrame, keys: Sequence[str], name: str = "Count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def bin_agg(
    df: DataFrame, ts: str, width: str, aggs: Sequence[Column], keys: Sequence[str] = ()
) -> DataFrame:
    """Aggregates per epoch-aligned time bin; bins without rows are absent."""
    return df.groupBy(*keys, bin_start(ts, width).alias(ts)).agg(*aggs)


def mean_by(df: DataFrame, keys: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(exact_avg(value).alias(name or f"avg_{value}"))


def distinct_counts(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], approx: bool = False
) -> DataFrame:
    """Several distinct counts at once.

    Exact counts first shuffle on (group, value), so one large group still spreads
    over all tasks. ``approx`` trades exactness for one sketch per group.
    """
    count = F.approx_count_distinct if approx else F.countDistinct
    return df.groupBy(*keys).agg(*(count(c).alias(f"distinct_{c}") for c in cols))


def monthly_stats(df: DataFrame, date: str, keys: Sequence[str], value: str) -> DataFrame:
    amount = money(value)
    return df.groupBy(month_of(date).alias("month"), *keys).agg(
        F.count("*").alias("txn_count"),
        F.sum(amount).alias("total_amount"),
        exact_avg(amount, MONEY_TO_SUM).alias("avg_amount"),
        F.min(amount).alias("min_amount"),
        F.max(amount).alias("max_amount"),
    )


def day_stats(
    df: DataFrame, start: str, end: str, keys: Sequence[str], truncate: bool = True
) -> DataFrame:
    """Average (integer by default), least and greatest number of days per group."""
    days = days_between(start, end)
    return df.groupBy(*keys).agg(
        F.count("*").alias("claim_count"),
        (int_avg(days) if truncate else exact_avg(days, "decimal(18,0)")).alias("avg_processing_days"),
        F.min(days).alias("min_days"),
        F.max(days).alias("max_days"),
    )


def distinct_list(
    df: DataFrame, keys: Sequence[str], value: str, name: str, sep: str = ", "
) -> DataFrame:
    """Sorted distinct values per group as one string.

    Duplicates go in a first aggregation on (group, value), so what reaches a
    group's task is its distinct values, which is what the result holds anyway.
    """
    unique = df.select(*keys, value).distinct()
    return unique.groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_list(value)), sep).alias(name)
    )


def greatest_text(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The greatest text of each group; NULL only where a group has nothing else.

    Equal texts go in a hash aggregation first, so only distinct ones are compared.
    """
    unique = df.select(*keys, F.col(value).alias(name)).distinct()
    return first_per_group(unique, keys, [F.desc_nulls_last(name)], 1)


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def first_seen(df: DataFrame, cols: Sequence[str], pos: Sequence[str]) -> DataFrame:
    """Distinct rows over ``cols``, each with its first position.

    A position of one column is compared as it is, several as packed numbers: neither needs a sort before the shuffle.
    """
    if len(pos) == 1:
        return df.groupBy(*cols).agg(F.min(pos[0]).alias("_first")).select(*cols, F.struct(F.col("_first").alias(pos[0])).alias("first_pos"))
    places = [f"_pos{i}" for i in range(len(pos))]
    rows = df.select(*cols, *(F.col(c).alias(p) for c, p in zip(pos, places)))
    return first_of(rows, cols, places, places).select(
        *cols, F.struct(*(F.col(p).alias(c) for c, p in zip(pos, places))).alias("first_pos"))
