"""Join shapes.

No side is broadcast by hint here: Catalyst and AQE broadcast a side when its
measured size allows it, and split skewed partitions of a sort-merge join
otherwise. A detail side is aggregated to one row per key *before* it meets its
base, because an outer join cannot split a hot key on its inner side.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .extremum import first_whole


def star_join(fact: DataFrame, dims: Iterable[tuple[DataFrame, str | list[str]]]) -> DataFrame:
    """Inner joins of a fact with its dimensions on equally named keys."""
    return reduce(lambda left, dim: left.join(dim[0], dim[1], "inner"), dims, fact)


def with_matches(fact: DataFrame, dims: Iterable[tuple[DataFrame, str]]) -> DataFrame:
    """Rows of a fact that an inner join with all dimensions would keep; only their keys are read."""
    return reduce(lambda left, dim: left.join(dim[0].select(dim[1]), dim[1], "left_semi"), dims, fact)


def fetch(few: DataFrame, details: Iterable[tuple[DataFrame, str]]) -> DataFrame:
    """Inner joins of a few rows, such as the first k of an order, with wide tables.

    The rows are broadcast to each table, so that none of its columns is shuffled; their number must be bounded.
    """
    return reduce(lambda left, detail: F.broadcast(left).join(detail[0], detail[1], "inner"), details, few)


def attach_aggs(
    base: DataFrame,
    detail: DataFrame,
    on: str,
    aggs: Sequence[Column],
    zero_fill: Sequence[str] = (),
) -> DataFrame:
    """Per-row aggregates of a detail table: a left join with its pre-aggregate.

    Counts belong in ``zero_fill``; sums and maxima of nothing stay NULL.
    """
    per_key = detail.groupBy(on).agg(*aggs)
    out = base.join(per_key, on, "left")
    return out.fillna(0, subset=list(zero_fill)) if zero_fill else out


def left_agg(
    base: DataFrame,
    detail: DataFrame,
    on: str,
    keys: Sequence[str],
    partial: Sequence[Column],
    final: Sequence[Column],
) -> DataFrame:
    """Outer join then group, with the detail side reduced to one row per join key first."""
    return attach_aggs(base, detail, on, partial).groupBy(*keys).agg(*final)


def keys_with_count(df: DataFrame, key: str, n: int = 1) -> DataFrame:
    """Keys that occur exactly ``n`` times."""
    return df.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") == n).select(key)


def groups_above_own_mean(
    df: DataFrame, group: str, value: str, total: str, count: str, factor: int = 2
) -> DataFrame:
    """Groups holding a value above ``factor`` times their own mean.

    A group has such a value exactly when its maximum is one, so the correlated
    subquery becomes a single aggregation that combines before the shuffle. Input
    rows may already be partial maxima with their sums and counts.
    """
    return (
        df.groupBy(group)
        .agg(
            F.max(value).alias("_max"),
            F.sum(total).alias("_sum"),
            F.sum(count).alias("_count"),
        )
        .filter(F.col("_max") * F.col("_count") > F.col("_sum") * factor)
        .select(group)
    )


def above_global_mean(df: DataFrame, value: str, factor: float = 2) -> DataFrame:
    """Rows above ``factor`` times the mean of the whole column.

    The mean enters as a scalar subquery: one row, computed once, not a join.
    """
    mean = df.agg(F.sum(value).alias("s"), F.count(value).alias("n"))
    threshold = mean.select(
        F.col("s").cast("double") / F.nullif(F.col("n"), F.lit(0)) * factor
    ).scalar()
    return df.filter(F.col(value).cast("double") > threshold)


def cross_count(sides: Sequence[DataFrame]) -> DataFrame:
    """Size of a Cartesian product without forming it: the product of the sizes."""
    sizes = [side.agg(F.count("*").cast("decimal(38,0)").alias("n")).scalar() for side in sides]
    product = reduce(lambda a, b: (a * b).cast("decimal(38,0)"), sizes)
    return sides[0].sparkSession.range(1).select(product.alias("pair_count"))


def with_named(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Per-row computed aliases."""
    return df.withColumns(dict(exprs))


def pick_one(base: DataFrame, detail: DataFrame, on: str, order: Sequence[str | Column]) -> DataFrame:
    """One detail row per base row: the first in ``order``, NULL first.

    The order is compared as packed numbers, in hash aggregations that combine before the shuffle; a
    ranked window would move every detail row of a hot key to one task.
    """
    places = [f"_order{i}" for i in range(len(order))]
    rows = detail.select(*detail.columns, *(
        (F.col(o) if isinstance(o, str) else o).alias(p) for o, p in zip(order, places)))
    best = first_whole(rows, [on], places).drop(*places)
    return base.join(best, on, "inner")


def update_from(base: DataFrame, updates: DataFrame, on: str, cols: Mapping[str, str]) -> DataFrame:
    """Overwrite ``base`` columns from matching ``updates`` rows, others stay.

    ``cols`` maps a base column to the update column. A match overwrites even with
    NULL. ``updates`` must hold one row per key.
    """
    fresh = updates.select(
        on, F.lit(True).alias("_hit"), *(F.col(src).alias(f"_new_{dst}") for dst, src in cols.items())
    )
    joined = base.join(fresh, on, "left")
    return joined.select(
        *(
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in cols else c
            for c in base.columns
        )
    )
