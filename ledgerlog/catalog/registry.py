"""Registry of bound queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bindings import Sample

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType)


def portable(df: DataFrame) -> DataFrame:
    """Types both engines report alike: BIGINT, DOUBLE and text for dates."""

    def adapt(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, _INTEGERS):
            return c.cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return c.cast("string").alias(field.name)
        return c

    return df.select(*(adapt(f) for f in df.schema.fields))


def query(name: str, sql: str | None = None):
    """Register ``fn(sample) -> DataFrame`` under ``name``, with its check if SQL has one."""

    def register(fn: Callable[[Sample], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return portable(fn(Sample(spark, folder)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
