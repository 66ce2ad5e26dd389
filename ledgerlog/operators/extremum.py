"""The first row of each group without a sort in front of the shuffle.

A minimum over a struct makes Spark sort all rows by group first, since only numbers of fixed width can be
aggregated in place in a hash table. Here several order columns are packed into one decimal
that keeps their order, and hash aggregations compare that.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WIDEST = 10**38
#: Timestamps are compared from 2^58 microseconds before 1970 to as many after (year -7000 to 11000).
TIME = 2**58
_INTEGERS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_FIXED = (*_INTEGERS, T.BooleanType, T.FloatType, T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


def whole(number: int) -> Column:
    return F.lit(str(number)).cast(f"decimal({len(str(abs(number)))},0)")


def double_rank(x: Column) -> Column:
    """A whole number that orders doubles as Spark does: infinities at the ends, NaN last, both zeros alike.

    It is the binary exponent and fraction taken apart by exact arithmetic: dividing by a power of two rounds nothing.
    """
    size = F.abs(x)
    near = F.floor(F.log2(size))
    power = F.pow(F.lit(2.0), near)
    exponent = near + F.when(power > size, -1).when(power * 2 <= size, 1).otherwise(0)
    normal = (exponent + 1023) * F.lit(2**52) + (
        (size / F.pow(F.lit(2.0), exponent) - 1) * F.lit(float(2**52))).cast("bigint")
    rank = (
        F.when(F.isnan(x), F.lit(2047 * 2**52 + 1))
        .when(size == float("inf"), F.lit(2047 * 2**52))
        .when(size < 2.0**-1022, F.try_divide(size, F.lit(5e-324)).cast("bigint"))
        .otherwise(normal)
    )
    return F.when(x < 0, -rank).otherwise(rank)


def _number(c: Column, kind: T.DataType) -> tuple[Column, int] | None:
    """``c`` as a whole number from 0 on, and how many there are; None for types without one."""
    if isinstance(kind, T.BooleanType):
        return c.cast("int"), 2
    if type(kind) in _INTEGERS:
        half = 2 ** (_INTEGERS[type(kind)] - 1)
        return c.cast("decimal(20,0)") + whole(half), 2 * half
    if isinstance(kind, T.DateType):
        return F.datediff(c, F.lit(dt.date(1970, 1, 1))).cast("decimal(20,0)") + whole(2**31), 2**32
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        if isinstance(kind, T.TimestampType):
            micros = F.unix_micros(c)
        else:
            since = (c - F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz")).cast("interval second")
            micros = (since.cast("decimal(24,6)") * 1_000_000).cast("bigint")
        inside = F.when(micros.isNotNull(), F.greatest(F.lit(-TIME), F.least(F.lit(TIME), micros)))
        return inside.cast("decimal(20,0)") + whole(TIME), 2 * TIME + 1
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        most = 2047 * 2**52 + 1
        return double_rank(c.cast("double")).cast("decimal(20,0)") + whole(most), 2 * most + 1
    if isinstance(kind, T.DecimalType) and kind.precision < 37:
        shifted = c.cast("decimal(38,%d)" % kind.scale) * whole(10**kind.scale)
        return shifted.cast("decimal(38,0)") + whole(10**kind.precision), 2 * 10**kind.precision + 1
    return None


def packed(df: DataFrame, order: Sequence[str]) -> list[Column] | None:
    """Decimals that compare like the columns in ``order``, NULL first, as many columns in each as fit.

    None if a column is of no fixed width.
    """
    keys: list[Column] = []
    room = 0
    for name in order:
        found = _number(F.col(name), df.schema[name].dataType)
        if found is None:
            return None
        number, size = found
        # 0 is left for NULL
        number, size = F.coalesce((number + 1).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")), size + 1
        if keys and room * size < WIDEST:
            keys[-1] = (keys[-1] * whole(size) + number).cast("decimal(38,0)")
            room *= size
        else:
            keys.append(number)
            room = size
    return keys


def fixed_width(df: DataFrame, names: Sequence[str]) -> bool:
    return all(isinstance(df.schema[n].dataType, _FIXED) for n in names)


def first_of(df: DataFrame, group: Sequence[str], order: Sequence[str], carry: Sequence[str] = (), last: bool = False) -> DataFrame:
    """``group`` and ``carry`` of the first row of each group in ``order`` (with ``last`` of the last one).

    NULL comes first, as in a struct. Columns in ``carry`` must be of fixed width. Order columns that fit one decimal
    are compared in one hash aggregation, which combines before the shuffle; each further decimal is a second
    aggregation on the ties of those before it. Rows that tie in all of ``order`` are told apart by nothing.
    An order column without fixed width (text) is compared as part of a struct, which sorts.
    """
    keys = packed(df, order)
    if keys is None or not fixed_width(df, carry):
        held = (F.max_by if last else F.min_by)(F.struct(*carry), F.struct(*order)).alias("_held")
        return df.groupBy(*group).agg(held).select(*group, "_held.*")
    names = [f"_key{i}" for i in range(len(keys))]
    return _first(df.select(*group, *carry, *(k.alias(n) for k, n in zip(keys, names))), group, names, carry, last)


def _first(rows: DataFrame, group: Sequence[str], keys: Sequence[str], carry: Sequence[str], last: bool) -> DataFrame:
    best = F.max_by if last else F.min_by
    for i in reversed(range(len(keys))):
        rows = rows.groupBy(*group, *keys[:i]).agg(*(best(c, keys[i]).alias(c) for c in carry if c not in keys[:i]))
    return rows


def first_whole(df: DataFrame, group: Sequence[str], order: Sequence[str], last: bool = False) -> DataFrame:
    """All columns of the first row of each group in ``order``.

    If all are of fixed width, they are carried through the aggregation. Otherwise a hash of the row
    follows the order, only numbers are aggregated, and the row is fetched by them; equal rows are one.
    """
    rest = [c for c in df.columns if c not in group]
    if packed(df, order) is None or fixed_width(df, rest):
        return first_of(df, group, order, rest, last).select(*df.columns)
    rows = df.withColumn("_row", F.xxhash64(*rest))
    keys = packed(rows, [*order, "_row"])
    names = [f"_at{i}" for i in range(len(keys))]
    rows = rows.select(*df.columns, *(k.alias(n) for k, n in zip(keys, names)))
    return fetched(rows, _first(rows, group, names, names, last), [*group, *names]).select(*df.columns)


def fetched(rows: DataFrame, kept: DataFrame, on: Sequence[str]) -> DataFrame:
    """``kept`` with the other columns of ``rows``; those that agree in ``on`` are equal, and one of them is taken."""
    rest = [c for c in rows.columns if c not in on]
    right = kept.select(*(F.col(c).alias(f"_r{i}") for i, c in enumerate(on)))
    alike = None
    for i, c in enumerate(on):
        same = F.col(c).eqNullSafe(F.col(f"_r{i}"))
        alike = same if alike is None else alike & same
    found = rows.join(right, alike, "left_semi")
    one = found.groupBy(*on).agg(F.collect_set(F.struct(*rest)).alias("_set"))
    return one.select(*on, F.inline("_set")) if rest else one.select(*on)
