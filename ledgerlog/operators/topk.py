"""Ordered prefixes, samples and first-seen unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """Sort and limit; Spark keeps k rows per task and merges them.

    ``order`` should end in columns that make it total, or ties are cut arbitrarily.
    """
    return df.orderBy(*order).limit(k)


def take(df: DataFrame, n: int = 50) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)


def sample_k(df: DataFrame, key: str, k: int, seed: str = "") -> DataFrame:
    """A repeatable random sample: the ``k`` smallest salted hashes of the key."""
    draw = F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)).cast("binary"))
    return df.orderBy(draw, key).limit(k)


def first_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], k: int) -> DataFrame:
    """The first ``k`` rows of each group.

    The rank filter is pushed below the shuffle (WindowGroupLimit): a task forwards
    at most ``k`` rows per group, so no group is ever gathered whole.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


_SIDE_BITS = 40


def union_first_seen(a: DataFrame, b: DataFrame, group: str, value: str, pos: str, cap: int) -> DataFrame:
    """Values of ``a`` then of ``b``, each once at its first place, ``cap`` per group.

    Places are not negative.
    """
    both = a.withColumn("_side", F.lit(0)).unionByName(b.withColumn("_side", F.lit(1)))
    # side and position in one number: a hash aggregation, without a sort in front of it
    at = F.shiftleft(F.col("_side").cast("bigint"), _SIDE_BITS) + F.col(pos)
    seen = both.groupBy(group, value).agg(F.min(at).alias("_at"))
    kept = first_per_group(seen, [group], ["_at"], cap)
    return kept.select(
        group, value, F.shiftright("_at", _SIDE_BITS).cast("int").alias("side"),
        F.col("_at").bitwiseAND(F.lit((1 << _SIDE_BITS) - 1)).cast("int").alias(pos))
