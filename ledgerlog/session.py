"""Session settings shared by the bench, the tests and batch jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings that change results or plans. Sizes are left to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state outside the heap, with incremental snapshots.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Per-group limits of any size are taken below the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": str(2**31 - 1),
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for callers that cannot name one.

    The cluster names it in ``spark.checkpoint.dir``; where that is unset it lies below the
    warehouse. Library functions do not choose: they take the folder as an argument.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/intermediate").rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a written intermediate once nothing reads it any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
