"""Typed table scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import BUSINESS, EVENT, PERF, conform


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet scan; a declared schema avoids opening footers to infer one."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The event log. Written by day, it also has ``event_date`` to prune folders by."""
    return read_table(spark, path, EVENT)


def read_perf(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, PERF)


def read_business(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The seven business tables below one folder."""
    return {name: read_table(spark, f"{root}/{name}", schema) for name, schema in BUSINESS.items()}


def read_business_jdbc(
    spark: SparkSession, url: str, key_bounds: Mapping[str, tuple[int, int]], partitions: int,
    server_names: Mapping[str, str] | None = None, options: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """The same tables from a live server, each read in key ranges by many tasks.

    ``key_bounds`` gives the smallest and largest primary key of every table,
    ``server_names`` the tables that are called differently there.
    """
    tables = {}
    for name, schema in BUSINESS.items():
        low, high = key_bounds[name]
        loaded = (
            spark.read.format("jdbc")
            .options(url=url, dbtable=(server_names or {}).get(name, name), **(options or {}))
            .option("partitionColumn", schema.names[0])
            .option("lowerBound", low)
            .option("upperBound", high)
            .option("numPartitions", partitions)
            .load()
        )
        tables[name] = conform(loaded, schema)
    return tables


def table_counts(tables: Mapping[str, DataFrame], names: Sequence[str] | None = None) -> DataFrame:
    """Row count per table, ordered by name."""
    counts = [
        tables[name].agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"))
        for name in (names or sorted(tables))
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("table_name")
