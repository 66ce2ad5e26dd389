"""Helpers of the corpus operators: shared folders, written stages, checks of columns."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PIECE_BYTES = 2 << 20
_SHIPPED: set[str] = set()


def shipped(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that tasks can import it anywhere."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        package = Path(__file__).resolve().parent.parent
        bundle = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(bundle, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(bundle))


def scratch(spark: SparkSession, name: str) -> str:
    """A folder nobody has used yet, below the one all executors share.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset the
    warehouse folder serves.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once and read it back: later work starts from these files, not from the lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a written stage nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(key: str | Column, divisor: int) -> Column:
    """crc32 of the key as text modulo ``divisor``; NULL for a NULL key."""
    return F.crc32((F.col(key) if isinstance(key, str) else key).cast("string").cast("binary")) % divisor


def hashed_sample(rows: DataFrame, group: str, key: str, n: int) -> DataFrame:
    """At most ``n`` rows of each group: those whose keys have the smallest hashes.

    Rows far beyond the n-th hash go before the ranking, so no task sees much more than
    ``n`` rows of a group, however many tasks there are. ``group`` must have few values.
    """
    sizes = F.broadcast(rows.groupBy(group).agg(F.count("*").alias("_size")))  # one row per group
    share = F.xxhash64(key) / F.lit(2.0**64) + 0.5
    near = rows.join(sizes, group).where(share <= 4.0 * n / F.col("_size"))
    order = Window.partitionBy(group).orderBy(F.xxhash64(key), key)
    return near.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= n).drop("_place", "_size")


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches of about ``limit`` bytes of ``text``; a longer row is a batch by itself."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        begin = total = 0
        for i, size in enumerate(sizes):
            if i > begin and total + size > limit:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += size
        if len(sizes) > begin:
            yield batch.slice(begin, len(sizes) - begin)
