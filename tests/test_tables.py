"""Collection rules, table reads and writes, streams."""

import datetime as dt

import pytest
from conftest import at
from pyspark.sql import functions as F

from ledgerlog.operators import collection as c
from ledgerlog.schemas import BUSINESS, EVENT, PERF, conform
from ledgerlog.session import fresh_path, shared_folder
from ledgerlog.sources import readers, writers
from ledgerlog.streaming import jobs


def test_collection_rules(spark):
    d = spark.createDataFrame(
        [("Application", 4, "x"), ("Application", 5, "MSSQLSERVER"), ("System", 4, "x"), ("System", 3, "x"),
         ("Security", 1, "MSSQLSERVER"), ("Application", 2, "MSSQL$SQLEXPRESS")],
        "EventLog string, EventLevel int, Source string")
    assert c.collect_events(d).count() == 4
    assert c.collect_events(d, c.NARROW_EVENT_RULES).count() == 3


def test_counter_paths(spark):
    paths = [r"\Processor(_Total)\% Processor Time", r"\Memory\Available MBytes",
             r"\MSSQL$SQLEXPRESS:Locks(_Total)\Average Wait Time (ms)", r"\Processor(0)\% Processor Time", "nonsense"]
    d = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, counter_path string")
    got = [tuple(r) for r in d.select("i", *(v.alias(k) for k, v in c.parse_counter_path("counter_path").items()))
           .orderBy("i").select("ObjectName", "InstanceName", "CounterName").collect()]
    assert got == [("Processor", "_Total", "% Processor Time"), ("Memory", None, "Available MBytes"),
                   ("MSSQL$SQLEXPRESS:Locks", "_Total", "Average Wait Time (ms)"),
                   ("Processor", "0", "% Processor Time"), (None, None, None)]
    assert sorted(r.i for r in c.collect_counters(d).collect()) == [0, 1, 2]
    parsed = d.withColumns(c.parse_counter_path("counter_path"))
    assert sorted(r.i for r in c.allow_counters(parsed).collect()) == [0, 1, 2, 3]


def test_sampling_capture_and_stats(spark):
    rows = [("vm", "o", "c", None, at("2026-04-20 10:00:05"), 1.0), ("vm", "o", "c", None, at("2026-04-20 10:00:55"), 2.0),
            ("vm", "o", "c", None, at("2026-04-20 10:01:00"), 3.0)]
    d = spark.createDataFrame(rows, "Computer string, ObjectName string, CounterName string, InstanceName string, "
                                    "TimeGenerated timestamp_ntz, CounterValue double")
    assert sorted(r.CounterValue for r in c.sample(d).collect()) == [2.0, 3.0]
    fields = ["sql_text", "database_name", "username", "client_app_name", "query_plan_hash"]
    q = spark.createDataFrame(
        [(at("2026-04-20 10:00:00"), "rpc_completed", 2_000_000, "h"), (at("2026-04-20 10:04:59"), "rpc_completed", 2_000_001, "h"),
         (at("2026-04-20 10:05:00"), "login", 9_000_000, "h")],
        "ts timestamp_ntz, event string, duration bigint, query_hash string").select("*", *(F.lit("x").alias(f) for f in fields))
    assert [r.duration for r in c.capture_slow(q).collect()] == [2_000_001]
    stats = {str(r.interval_start): (r.executions, r.avg_duration, r.max_duration) for r in c.runtime_stats(q).collect()}
    assert stats == {"2026-04-20 10:00:00": (2, 2_000_000.5, 2_000_001), "2026-04-20 10:05:00": (1, 9e6, 9_000_000)}


def test_conform_refuses_unknown_columns(spark):
    d = spark.createDataFrame([("Error",)], "EventLevelName string")
    assert conform(d, EVENT).columns == EVENT.names
    with pytest.raises(ValueError):
        conform(d.withColumn("Made_Up", F.lit(1)), EVENT)


def test_round_trips(spark):
    path = fresh_path(spark, "t")
    rows = [(at("2026-04-19 23:00:00"), "Error"), (at("2026-04-20 01:00:00"), "Warning")]
    log = conform(spark.createDataFrame(rows, "TimeGenerated timestamp, EventLevelName string"), EVENT)
    writers.write_log(log, path)
    back = spark.read.parquet(path)
    assert {str(r.event_date) for r in back.collect()} == {"2026-04-19", "2026-04-20"}
    assert writers.drop_expired(back, dt.date(2026, 4, 20), 0).count() == 1
    events = readers.read_events(spark, path)
    assert events.drop("event_date").schema == EVENT and events.count() == 2
    perf = fresh_path(spark, "p")
    writers.append(spark.createDataFrame([("Memory", 1.5)], "ObjectName string, CounterValue double"), perf, PERF)
    writers.append(spark.createDataFrame([("Memory", 2.5)], "ObjectName string, CounterValue double"), perf, PERF)
    assert readers.read_perf(spark, perf).count() == 2
    root = fresh_path(spark, "b")
    for name, schema in BUSINESS.items():
        writers.replace(conform(spark.range(3).select(F.col("id").alias(schema.names[0])), schema), f"{root}/{name}")
    tables = readers.read_business(spark, root)
    assert [tuple(r) for r in readers.table_counts(tables).collect()] == [(n, 3) for n in sorted(BUSINESS)]


def test_result_pages(spark):
    page = writers.result_page(spark.range(80))
    assert page.count() == 50 and writers.result_status(page) == "OK"
    assert writers.result_rows(spark.range(80))[0].keys() == {"id"}
    assert "0 rows" in writers.result_status(spark.range(0))
    assert writers.result_status(None) == "Query returned no tables."
    assert writers.result_status(page, "timed out").endswith("timed out): timed out")


def test_bucketed_join_needs_no_shuffle(spark):
    rows = spark.range(1000).select(F.col("id").alias("policy_id"), (F.col("id") * 2).alias("x"))
    writers.save_bucketed(rows, "left_side", "policy_id", 4)
    writers.save_bucketed(rows.withColumnRenamed("x", "y"), "right_side", "policy_id", 4)
    joined = spark.table("left_side").hint("merge").join(spark.table("right_side"), "policy_id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 1000


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def stream_of(spark, batches, ddl):
    """Folder with one file per batch, read one file per trigger."""
    folder = fresh_path(spark, "in")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema
    return jobs.read_stream(spark, folder, schema, files_per_trigger=1)


def run(query):
    query.awaitTermination()


def test_late_rows(spark):
    newest = at("2026-04-20 12:15:00")
    late = [(newest - dt.timedelta(minutes=m), m) for m in (14, 15, 16)]  # 12:01, 12:00, 11:59
    source = stream_of(
        spark, [[(newest, 0)], [(newest, 1)], late, [(at("2026-04-20 15:00:00"), 99)]], "ts timestamp_ntz, id int")
    sink = fresh_path(spark, "out")
    hourly = jobs.windowed(source, "ts", [], [F.count("*").alias("n")])
    run(jobs.start_windowed(hourly, sink, fresh_path(spark, "cp")))
    got = {r.bin_start.hour: r.n for r in spark.read.parquet(sink).collect()}
    # the 11 o'clock window closed at the watermark 12:00, so the row 16 minutes late is gone
    assert got == {12: 4}


def test_stream_equals_batch_and_restarts(spark):
    rows = [(at("2026-04-20 10:00:00") + dt.timedelta(minutes=7 * i), "ab"[i % 2], i) for i in range(60)]
    ddl = "ts timestamp_ntz, kind string, id int"
    source = stream_of(spark, [rows[:30], rows[30:]], ddl)
    sink, progress = fresh_path(spark, "out"), fresh_path(spark, "cp")
    aggs = [F.count("*").alias("n"), F.max("id").alias("m")]
    for _ in range(2):  # a second run finds nothing new
        run(jobs.start_windowed(jobs.windowed(source, "ts", ["kind"], aggs), sink, progress))
    got = {(r.bin_start, r.kind): (r.n, r.m) for r in spark.read.parquet(sink).collect()}
    batch = spark.createDataFrame(rows, ddl).groupBy(F.window("ts", "1 hour").alias("w"), "kind").agg(*aggs)
    closed = {(r.w.start, r.kind): (r.n, r.m) for r in batch.collect()
              if r.w.end <= rows[-1][0] - dt.timedelta(minutes=15)}
    assert got == closed and got


def test_redelivery_alerts_and_routing(spark):
    rows = [(at("2026-04-20 10:00:00"), i, "DEADLOCK x" if i % 3 == 0 else "fine", "Event" if i % 2 else "Perf")
            for i in range(9)]
    ddl = "ts timestamp_ntz, id int, RenderedDescription string, kind string"
    once = fresh_path(spark, "once")
    run(jobs.start_deduplicated(stream_of(spark, [rows, rows[:5]], ddl), ["id"], "ts", once, fresh_path(spark, "cp")))
    assert spark.read.parquet(once).count() == 9
    alarm = fresh_path(spark, "alarm")
    run(jobs.start_alerts(stream_of(spark, [rows], ddl), jobs.append_batch(alarm), fresh_path(spark, "cp")))
    assert sorted(r.id for r in spark.read.parquet(alarm).collect()) == [0, 3, 6]
    sink = fresh_path(spark, "routed")
    run(jobs.start_routing(stream_of(spark, [rows[:4], rows[4:]], ddl), sink, fresh_path(spark, "cp"), ts="ts"))
    assert jobs.routed(spark, sink, "Event").count() == 4 and jobs.routed(spark, sink, "Perf").count() == 5


def test_sinks_show_finished_batches_only(spark):
    rows = [(at("2026-04-20 10:00:00"), i, "DEADLOCK", "Event" if i % 2 else "Perf") for i in range(6)]
    feed = spark.createDataFrame(rows, "ts timestamp_ntz, id int, RenderedDescription string, kind string")
    sink, alarm = fresh_path(spark, "routed"), fresh_path(spark, "alarm")
    empty = jobs.routed(spark, sink, "Event", schema=feed.schema)
    assert empty.columns == ["ts", "id", "RenderedDescription", "event_date"] and empty.count() == 0
    run(jobs.start_routing(stream_of(spark, [rows], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in feed.schema)),
                           sink, fresh_path(spark, "cp"), ts="ts"))
    half = feed.withColumn("event_date", F.to_date("ts")).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    half.partitionBy("kind", "event_date").parquet(f"{sink}/batch=7")
    found = jobs.routed(spark, sink, "Event", schema=feed.schema)
    assert found.schema == empty.schema and sorted(r.id for r in found.collect()) == [1, 3, 5]
    notify = jobs.append_batch(alarm)
    for number, part in ((0, feed.where("id < 3")), (1, feed.where("id >= 3")), (1, feed.where("id >= 3"))):
        notify(part, number)
    assert sorted((r.batch, r.id) for r in jobs.batches(spark, alarm, feed.schema).collect()) == [
        (0, 0), (0, 1), (0, 2), (1, 3), (1, 4), (1, 5)]


def test_ingested_events_are_pruned_by_day(spark, golden):
    from conftest import NOW, plan
    from ledgerlog.plans import logs

    source = fresh_path(spark, "feed")
    golden.write.parquet(source)
    sink = fresh_path(spark, "ingest")
    stream = jobs.read_stream(spark, source, spark.read.parquet(source).schema)
    run(jobs.start_event_ingest(stream, sink, fresh_path(spark, "cp")))
    found = logs.l10(spark.read.parquet(sink), NOW)
    assert "PartitionFilters: [isnotnull(event_date" in plan(found) and found.count() == 5
