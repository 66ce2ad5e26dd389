"""Streaming jobs run to the end of the sample files, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import exact_avg
from ..operators import rollup
from ..session import fresh_path
from ..streaming import jobs
from .bindings import EVENT_COLUMNS, FEED_COLUMNS, Sample, over, with_number
from .registry import query


def _events(s: Sample) -> DataFrame:
    """The events table as a stream.

    The character class makes the path a pattern, which a stream accepts whether the
    table is one file or a folder of files.
    """
    return jobs.read_stream(s.spark, f"{s.folder}/events.parque[t]", s.table("events").schema)


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return with_number(df).selectExpr(*(f"{expr} AS {name}" for name, expr in columns.items()))


def _finish(running) -> None:
    running.awaitTermination()


@query("str01_ingest_events", over("log") + """SELECT TimeGenerated, Source, EventLog, EventLevel FROM log
  WHERE (EventLog = 'Application' AND EventLevel IN (1, 2, 3, 4)) OR (EventLog = 'System'
  AND EventLevel IN (1, 2, 3))""")
def _str01(s):
    sink = fresh_path(s.spark, "ingest")
    _finish(jobs.start_event_ingest(_project(_events(s), EVENT_COLUMNS), sink, fresh_path(s.spark, "progress")))
    return s.spark.read.parquet(sink).select("TimeGenerated", "Source", "EventLog", "EventLevel")


@query("str01_ingest_counters", over("perf") + """SELECT p.TimeGenerated, p.ObjectName, p.CounterName, p.CounterValue
  FROM perf p JOIN events e ON e.ts = p.TimeGenerated WHERE regexp_extract(e.props, '([0-9]+)', 1)::int >= 10""")
def _str01_perf(s):
    sink = fresh_path(s.spark, "ingest")
    _finish(jobs.start_perf_ingest(_project(_events(s), FEED_COLUMNS), sink, fresh_path(s.spark, "progress")))
    return s.spark.read.parquet(sink).select("TimeGenerated", "ObjectName", "CounterName", "CounterValue")


@query("str02_hourly_windows", """SELECT bin_start, event_type, n, total / n AS avg_value, max_value FROM (
  SELECT time_bucket(interval 1 hour, ts) AS bin_start, event_type, count(*) AS n,
  cast(sum(cast(value as decimal(18,4))) as double) AS total, max(value) AS max_value FROM events GROUP BY 1, 2)
  WHERE bin_start + interval 1 hour <= (SELECT max(ts) FROM events) - interval 15 minute""")
def _str02(s):
    sink = fresh_path(s.spark, "windows")
    aggs = [F.count("*").alias("n"), exact_avg("value").alias("avg_value"), F.max("value").alias("max_value")]
    hourly = jobs.windowed(_events(s), "ts", ["event_type"], aggs)
    _finish(jobs.start_windowed(hourly, sink, fresh_path(s.spark, "progress")))
    return s.spark.read.parquet(sink).select(
        F.col("bin_start").cast("timestamp_ntz").alias("bin_start"), "event_type", "n", "avg_value", "max_value"
    )


BATCHES = 4


def _rolled(s: Sample) -> tuple[str, DataFrame]:
    """A roll-up of the events, fed by batches that each hold rows of every hour, so that most come late.

    The first two batches are merged by a compaction that runs in between.
    """
    arrived, sink, progress = (fresh_path(s.spark, n) for n in ("arrived", "rollup", "progress"))
    events = s.table("events")
    empty = rollup.states(events, "ts", ["event_type"], "value", ["user_id"]).schema
    for part in range(BATCHES):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(BATCHES)) == part).write.mode("append").parquet(arrived)
        feed = jobs.read_stream(s.spark, arrived, events.schema)
        _finish(jobs.start_rollup(feed, "ts", ["event_type"], "value", sink, progress, ["user_id"]))
        if part == 1:
            rollup.compact(s.spark, sink, empty, ["event_type"], ["user_id"])
    return sink, rollup.stored(s.spark, sink, empty)


@query("str02_rollup_hourly", """SELECT time_bucket(interval 1 hour, ts) AS hour, event_type, count(*) AS n,
  cast(sum(cast(value as decimal(18,4))) as double) / count(value) AS mean, min(value) AS least, max(value) AS most
  FROM events GROUP BY 1, 2""")
def _rollup_hourly(s):
    return rollup.summary(_rolled(s)[1], ["hour", "event_type"])


@query("str02_rollup_range", """SELECT time_bucket(interval 1 hour, ts) AS hour, count(*) AS n,
  cast(sum(cast(value as decimal(18,4))) as double) / count(value) AS mean, min(value) AS least, max(value) AS most
  FROM events WHERE ts BETWEEN timestamp '2024-01-10 07:20:00' AND timestamp '2024-01-20 21:40:00' GROUP BY 1""")
def _rollup_range(s):
    parts = rollup.in_range(_rolled(s)[1], s.table("events"), "ts", ["event_type"], "value",
                            "2024-01-10 07:20:00", "2024-01-20 21:40:00", ["user_id"])
    return rollup.summary(parts, ["hour"])


@query("agg05_distinct_from_sketches", """SELECT event_type, count(DISTINCT user_id) AS users, true AS close
  FROM events GROUP BY 1""")
def _rollup_distinct(s):
    kept = rollup.summary(_rolled(s)[1], ["event_type"], ["user_id"])
    exact = s.table("events").groupBy("event_type").agg(F.countDistinct("user_id").alias("users"))
    return exact.join(kept, "event_type").select(
        "event_type", "users", (F.abs(F.col("distinct_user_id") - F.col("users")) <= 0.05 * F.col("users")).alias("close"))


@query("str03_once_per_key", "SELECT event_id, user_id, value FROM events")
def _str03(s):
    sink = fresh_path(s.spark, "once")
    twice = _events(s).unionByName(_events(s))
    _finish(jobs.start_deduplicated(twice, ["event_id"], "ts", sink, fresh_path(s.spark, "progress")))
    return s.spark.read.parquet(sink).select("event_id", "user_id", "value")


@query("str04_alerts", over("log") + """SELECT TimeGenerated, RenderedDescription FROM log
  WHERE RenderedDescription ILIKE '%slow query warning%' OR RenderedDescription ILIKE '%deadlock%'""")
def _str04(s):
    sink = fresh_path(s.spark, "alerts")
    log = _project(_events(s), EVENT_COLUMNS)
    _finish(jobs.start_alerts(log, jobs.append_batch(sink), fresh_path(s.spark, "progress")))
    return s.spark.read.parquet(sink).select("TimeGenerated", "RenderedDescription")


_KIND = "CASE WHEN event_type IN ('error', 'view') THEN 'Event' ELSE 'Perf' END"


@query("str05_two_table_routing", f"SELECT {_KIND} AS destination, event_id, event_type FROM events")
def _str05(s):
    sink = fresh_path(s.spark, "routed")
    mixed = _events(s).withColumn("kind", F.expr(_KIND))
    _finish(jobs.start_routing(mixed, sink, fresh_path(s.spark, "progress"), ts="ts"))
    parts = [
        jobs.routed(s.spark, sink, name).select(F.lit(name).alias("destination"), "event_id", "event_type")
        for name in jobs.ROUTED
    ]
    return parts[0].unionByName(parts[1])
