"""Hourly roll-ups kept as exact states that can be merged in any order.

A state is one row per hour and group: numbers of rows and values, an exact sum, the extremes and,
on request, sketches of distinct values. Rows that arrive late make a further state of an old hour;
nothing is rewritten for them. States are stored in folders that name the micro-batches they hold,
and several folders can be merged into one. A question over whole hours reads states only, a ragged
range adds the raw rows of its first and its last hour.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructType

from ..functions.stats import SMALLEST
from ..functions.timewin import When, bin_start, moment, ts_lit

HOUR = dt.timedelta(hours=1)
FIXED = "decimal(28,10)"
#: log2 of the registers of a sketch; its relative error is about 1.04 / sqrt(2 ** 12), 1.6 %.
REGISTERS = 12


def _sketch(name: str) -> str:
    return f"sketch_{name}"


def _sealed(total: Column, filled: Column) -> Column:
    """1 where an exact sum overflowed, so that the plain one has to serve."""
    return F.when(total.isNull() & (filled > 0), 1).otherwise(0)


def states(df: DataFrame, ts: str, keys: Sequence[str], value: str, distinct: Sequence[str] = ()) -> DataFrame:
    """One state per hour and group. Rows without a time belong to no hour and are left out."""
    number = F.col(value).cast("double")
    held = F.col(value).try_cast(FIXED)
    odd = number.isNotNull() & (held.isNull() | ((number != 0) & (F.abs(number) < SMALLEST)))
    total = F.try_sum(held)
    return df.where(F.col(ts).isNotNull()).groupBy(bin_start(ts, "1 hour").alias("hour"), *keys).agg(
        F.count("*").alias("n"), F.count(value).alias("filled"), total.alias("total"), F.sum(number).alias("plain"),
        (F.count_if(odd) + _sealed(total, F.count(held))).cast("bigint").alias("odd"),
        F.min(value).alias("least"), F.max(value).alias("most"),
        *(F.hll_sketch_agg(c, REGISTERS).alias(_sketch(c)) for c in distinct))


def merged(rows: DataFrame, keys: Sequence[str], distinct: Sequence[str] = ()) -> DataFrame:
    """States of the same ``keys`` (with or without ``hour``) made one."""
    total = F.try_sum("total")
    return rows.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("filled").alias("filled"), total.alias("total"), F.sum("plain").alias("plain"),
        (F.sum("odd") + _sealed(total, F.count("total"))).cast("bigint").alias("odd"),
        F.min("least").alias("least"), F.max("most").alias("most"),
        *(F.hll_union_agg(_sketch(c)).alias(_sketch(c)) for c in distinct))


def summary(rows: DataFrame, keys: Sequence[str], distinct: Sequence[str] = ()) -> DataFrame:
    """``keys``, n, mean, least, most and the estimated distinct counts of merged states.

    The mean equals ``exact_avg`` over the rows: a quotient of the exact sum, or of the plain
    one where a value does not fit.
    """
    base = F.nullif(F.col("filled"), F.lit(0)).cast("double")
    mean = F.when(F.col("odd") == 0, F.col("total").cast("double") / base).otherwise(F.col("plain") / base)
    return merged(rows, keys, distinct).select(
        *keys, "n", mean.alias("mean"), "least", "most",
        *(F.hll_sketch_estimate(_sketch(c)).alias(f"distinct_{c}") for c in distinct))


def in_range(
    stored: DataFrame, raw: DataFrame, ts: str, keys: Sequence[str], value: str, start: When, end: When,
    distinct: Sequence[str] = (),
) -> DataFrame:
    """States of the rows from ``start`` to ``end``, both included, some hours in several parts.

    Whole hours come from ``stored``; ``raw`` is read for what is left of the first and the last
    hour, by bounds that reach its scan. ``merged`` and ``summary`` put the parts together.
    """
    begin, stop = moment(start), moment(end)
    floor = lambda t: t.replace(minute=0, second=0, microsecond=0)
    first, last = floor(begin + HOUR - dt.timedelta(microseconds=1)), floor(stop)
    time = F.col(ts)
    if first > last:
        return states(raw.where((time >= ts_lit(begin)) & (time <= ts_lit(stop))), ts, keys, value, distinct)
    edge = raw.where(((time >= ts_lit(begin)) & (time < ts_lit(first))) | ((time >= ts_lit(last)) & (time <= ts_lit(stop))))
    whole = stored.where((F.col("hour") >= ts_lit(first)) & (F.col("hour") < ts_lit(last)))
    if "hour_date" in stored.columns:
        whole = whole.where(F.col("hour_date").between(F.lit(first.date()), F.lit(last.date()))).drop("hour_date")
    return whole.unionByName(states(edge, ts, keys, value, distinct))


def store(rows: DataFrame, folder: str, first: int, last: int) -> None:
    """Write the states of batches ``first`` to ``last``; the same batches again replace what they wrote."""
    rows.withColumn("hour_date", F.to_date("hour")).write.mode("overwrite").partitionBy("hour_date").parquet(
        f"{folder}/first={first}/last={last}")


def _finished(spark: SparkSession, folder: str) -> list[tuple[int, int]]:
    """The stretches of batches to read: each batch once, in the longest finished stretch that holds it.

    One entry per folder, listed on the driver; ``compact`` keeps them few.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/first=*/last=*/_SUCCESS")
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(root) or []
    spans = sorted(
        ((int(f.getPath().getParent().getParent().getName().split("=")[1]),
          int(f.getPath().getParent().getName().split("=")[1])) for f in found),
        key=lambda span: (span[0], -span[1]))
    out: list[tuple[int, int]] = []
    for span in spans:
        if not out or span[0] > out[-1][1]:
            out.append(span)
    return out


def stored(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The states in ``folder``, with the day their folders are named after.

    ``schema`` is that of ``states``. Batches that are still being written, or failed, are not
    read; without any the result is empty.
    """
    spans = _finished(spark, folder)
    whole = StructType(list(schema.fields)).add("hour_date", DateType())
    if not spans:
        return spark.createDataFrame([], whole)
    with_places = StructType(list(whole.fields)).add("first", LongType()).add("last", LongType())
    paths = [f"{folder}/first={first}/last={last}" for first, last in spans]
    return spark.read.schema(with_places).option("basePath", folder).parquet(*paths).drop("first", "last")


def compact(spark: SparkSession, folder: str, schema: StructType, keys: Sequence[str], distinct: Sequence[str] = ()) -> None:
    """Merge the finished stretches into one.

    It counts from the moment it is complete; the stretches it replaces stay on disk for readers that
    began before, and are no longer read. A batch delivered again writes what is already merged.
    """
    spans = _finished(spark, folder)
    if len(spans) > 1:
        rows = merged(stored(spark, folder, schema), ["hour", *keys], distinct)
        store(rows, folder, spans[0][0], spans[-1][1])
