"""Running totals and row numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import zero_fill


def running_total(daily: DataFrame, keys: Sequence[str], order: str, value: str, name: str) -> DataFrame:
    """Running sum of an already aggregated series.

    Each key holds one row per period by then, so a window partition is as long as
    the calendar, however many rows the key had.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    return daily.withColumn(name, F.sum(value).over(w))


def number_rows(
    few: DataFrame, order: Sequence[str], prefix: Column, name: str, width: int = 3
) -> DataFrame:
    """Numbered references for a small batch: prefix plus position, padded to ``width`` digits.

    Positions with more digits keep them all, so references differ. Meant for the output of
    a ``limit``, which one task holds anyway. For a batch of any size see ``dense_ids``.
    """
    w = Window.partitionBy(F.lit(0)).orderBy(*order)
    return few.withColumn(name, F.concat(prefix, zero_fill(F.row_number().over(w), width)))


# A row's place as Spark's monotonic ids encode it: partition above, position below.
_POSITION_BITS = 33


def dense_ids(
    df: DataFrame, key: str, name: str, path: str, start: int = 1, slices: int | None = None
) -> DataFrame:
    """Gapless ids in the order of a unique ``key``, without a global sort task.

    The rows are range-partitioned and sorted, and written with their partition and
    position to ``path``, a new folder that all executors reach, so that a lost executor
    cannot shift a boundary. What is left is to add the row counts of the partitions before.
    The result reads ``path``; once it is stored elsewhere, ``session.remove`` may delete it.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(*([slices] if slices else []), key).sortWithinPartitions(key)
    ranged.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path).withColumn("_slice", F.shiftright("_at", _POSITION_BITS))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_slice")
        .agg(F.count("*").alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    # one row per partition
    return (
        placed.join(F.broadcast(offsets), "_slice")
        .withColumn(name, F.col("_offset") + position + F.lit(start))
        .drop("_slice", "_at", "_offset")
    )
