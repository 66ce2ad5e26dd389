"""Table writes and result pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import conform


def append(df: DataFrame, path: str, schema: StructType | None = None) -> None:
    (conform(df, schema) if schema else df).write.mode("append").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    """Drop what is there and write anew. Never the path the input itself is read from."""
    df.write.mode("overwrite").parquet(path)


def write_log(df: DataFrame, path: str, ts: str = "TimeGenerated", mode: str = "append") -> None:
    """Log rows in one folder per day.

    REBALANCE lets AQE cut a heavy day into several files and merge light days,
    so neither a hot day nor a flood of small files forms.
    """
    daily = df.withColumn("event_date", F.to_date(ts)).hint("rebalance", "event_date")
    daily.write.mode(mode).partitionBy("event_date").parquet(path)


def drop_expired(df: DataFrame, as_of_date: object, days: int = 30) -> DataFrame:
    """Partition filter that goes with ``operators.collection.retain``."""
    return df.filter(F.col("event_date") >= F.date_sub(F.lit(as_of_date), days))


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """A table bucketed and sorted by its join key: later joins on it need no shuffle.

    Rows are placed by bucket first, so each bucket is one file. A key that holds a large
    share of the rows makes one large bucket; leave such a table unbucketed, where AQE can
    split the key at join time.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .format("parquet")
        .saveAsTable(table)
    )


def result_page(df: DataFrame, n: int = 50) -> DataFrame:
    """The rows a reader sees: at most ``n``."""
    return df.limit(n)


# What a reader is told about a result.
NO_ROWS = "Query executed successfully but returned 0 rows."
NO_TABLE = "Query returned no tables."
PARTIAL = "Partial results (query may have timed out): "


def result_status(page: DataFrame | None, partial_error: str | None = None) -> str:
    """State of a result: absent, cut short with its reason, empty, or OK."""
    if partial_error is not None:
        return PARTIAL + partial_error
    if page is None:
        return NO_TABLE
    return NO_ROWS if page.isEmpty() else "OK"


def result_rows(page: DataFrame, n: int = 50) -> list[dict]:
    """The page as dicts; bounded by ``n`` whatever ``page`` is."""
    return [row.asDict(recursive=True) for row in page.limit(n).collect()]
