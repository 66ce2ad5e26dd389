"""Structured Streaming jobs.

Each ``start_*`` returns a running query. Sources are folders of Parquet files;
state and progress live in the given checkpoint, so a restarted job goes on where
it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StructType

from ..functions.text import contains_any
from ..operators.collection import EVENT_RULES, EventRule, collect_counters, collect_events
from ..operators.rollup import states, store

LATENESS = "15 minutes"
#: Files a micro-batch takes at most, so that a backlog comes in bounded pieces.
FILES_PER_TRIGGER = 1000
#: The two tables a mixed feed goes to.
ROUTED = ("Event", "Perf")
ALERT_WORDS = ("SLOW QUERY WARNING", "DEADLOCK")


def read_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = FILES_PER_TRIGGER,
    name_filter: str | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.parquet(path)


def _start(df: DataFrame, sink: str, checkpoint: str, every: str | None, *folders: str) -> StreamingQuery:
    writer = df.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    return _trigger(writer.partitionBy(*folders) if folders else writer, every).start()


def _daily(df: DataFrame, ts: str = "TimeGenerated") -> DataFrame:
    """With the day its folder is named after, which ``timewin.during`` prunes by."""
    return df.withColumn("event_date", F.to_date(ts))


def _trigger(writer, every: str | None):
    """Continuous micro-batches at an interval, or everything there is and stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_event_ingest(
    events: DataFrame, sink: str, checkpoint: str, rules: Sequence[EventRule] = EVENT_RULES,
    every: str | None = None,
) -> StreamingQuery:
    """Append the events the collection rules keep, in one folder per day."""
    return _start(_daily(collect_events(events, rules)), sink, checkpoint, every, "event_date")


def start_perf_ingest(feed: DataFrame, sink: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append the samples of listed counter paths, split into columns, in one folder per day."""
    return _start(_daily(collect_counters(feed)), sink, checkpoint, every, "event_date")


def windowed(
    df: DataFrame, ts: str, keys: Sequence[str], aggs: Sequence[Column], width: str = "1 hour",
    lateness: str = LATENESS,
) -> DataFrame:
    """Tumbling aggregates that wait ``lateness`` for stragglers.

    The time column becomes TIMESTAMP, which watermarks need. A window appears once
    the newest event is ``lateness`` past its end; only open windows are in state.
    """
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    return (
        timed.groupBy(F.window(ts, width).alias("_w"), *keys)
        .agg(*aggs)
        .select(F.col("_w.start").alias("bin_start"), F.col("_w.end").alias("bin_end"), "*")
        .drop("_w")
    )


def start_windowed(df: DataFrame, sink: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    return _start(df, sink, checkpoint, every)


def start_rollup(
    df: DataFrame, ts: str, keys: Sequence[str], value: str, sink: str, checkpoint: str,
    distinct: Sequence[str] = (), every: str | None = None,
) -> StreamingQuery:
    """Add the hourly states of every micro-batch to a roll-up.

    No row is too late and nothing is held in memory: a late row is a further state of its hour. A
    batch that is delivered again replaces its own states. ``rollup.stored`` reads the roll-up.
    """

    def write(batch: DataFrame, number: int) -> None:
        store(states(batch, ts, keys, value, distinct), sink, number, number)

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def once_per_key(df: DataFrame, keys: Sequence[str], ts: str, lateness: str = LATENESS) -> DataFrame:
    """Drop redelivered rows; keys are forgotten ``lateness`` behind the newest event."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    return timed.dropDuplicatesWithinWatermark(list(keys))


def start_deduplicated(
    df: DataFrame, keys: Sequence[str], ts: str, sink: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    return _start(once_per_key(df, keys, ts), sink, checkpoint, every)


def alerts(df: DataFrame, words: Sequence[str] = ALERT_WORDS) -> DataFrame:
    return df.filter(contains_any("RenderedDescription", words))


def start_alerts(
    df: DataFrame, notify: Callable[[DataFrame, int], None], checkpoint: str,
    words: Sequence[str] = ALERT_WORDS, every: str | None = None,
) -> StreamingQuery:
    """Hand every micro-batch of alerting rows to ``notify``.

    A batch may be handed over again after a failure; ``notify`` gets its number to
    recognise that.
    """
    writer = alerts(df, words).writeStream.foreachBatch(notify).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def append_batch(sink: str) -> Callable[[DataFrame, int], None]:
    """Batch writer that gives the same files for the same batch number; ``batches`` reads them back."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={number}")

    return write


def start_routing(
    mixed: DataFrame, sink: str, checkpoint: str, kind: str = "kind", ts: str = "TimeGenerated",
    kinds: Sequence[str] = ROUTED, every: str | None = None,
) -> StreamingQuery:
    """Write a mixed feed in folders by destination and day, each micro-batch once.

    Rows of other kinds are not for either table. ``routed`` reads one destination back.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = _daily(batch.filter(F.col(kind).isin(*kinds)), ts)
        rows.write.mode("overwrite").partitionBy(kind, "event_date").parquet(f"{sink}/batch={number}")

    writer = mixed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, every).start()


def batches(spark: SparkSession, sink: str, schema: StructType | None = None) -> DataFrame:
    """The rows of all finished micro-batches in ``sink``, each batch once, with its number as ``batch``.

    A batch counts once its folder carries the marker that its writer leaves last, so one
    that is being written, or written again, is not read half. With a ``schema`` an empty
    sink reads as an empty table. One entry per batch is listed on the driver.
    """
    marks = spark._jvm.org.apache.hadoop.fs.Path(f"{sink}/batch=*/_SUCCESS")
    found = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks) or []
    paths = sorted(f"{sink}/{f.getPath().getParent().getName()}" for f in found)
    known = schema and StructType(list(schema.fields)).add("batch", LongType())
    if not paths and known:
        return spark.createDataFrame([], known)
    reader = spark.read.option("basePath", sink)
    return (reader.schema(known) if known else reader).parquet(*paths)


def routed(
    spark: SparkSession, sink: str, name: str, kind: str = "kind", schema: StructType | None = None
) -> DataFrame:
    """The rows of one destination in finished batches; other folders are not read.

    ``schema`` is that of the mixed feed; it is needed while the sink may be empty.
    """
    daily = schema and StructType(list(schema.fields)).add("event_date", DateType())
    return batches(spark, sink, daily).filter(F.col(kind) == name).drop("batch", kind)
