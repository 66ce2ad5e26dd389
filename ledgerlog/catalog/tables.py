"""Collection rules, table reads and writes, snapshots and data quality."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import collection as c
from ..operators import quality as dq
from ..operators import snapshots as snap
from ..operators.joins import update_from
from ..schemas import BUSINESS, EVENT, PERF, conform
from ..session import fresh_path
from ..sources import readers, textindex, writers
from .bindings import over
from .registry import query

AS_OF = "2024-01-20 15:00:00"


# Scans and schemas

query("src01_event_schema", over("log") + """SELECT TimeGenerated, Source, EventLog, EventID, EventLevelName,
  EventLevel, RenderedDescription, Computer, cast(NULL as bigint) AS EventCategory, NULL AS UserName,
  NULL AS "_ResourceId" FROM log""")(
    lambda s: conform(s.log, EVENT).withColumn("TimeGenerated", F.col("TimeGenerated").cast("timestamp_ntz")))

query("src02_perf_schema", over("perf") + """SELECT TimeGenerated, ObjectName, CounterName, InstanceName,
  CounterValue, Computer, NULL AS "_ResourceId" FROM perf""")(
    lambda s: conform(s.perf, PERF).withColumn("TimeGenerated", F.col("TimeGenerated").cast("timestamp_ntz")))

query("src03_business_tables", over("customers", "policies", "packages", "agents", "claims", "transactions",
                                    "beneficiaries") + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, count(DISTINCT {BUSINESS[t].names[0]}) AS keys FROM {t}"
    for t in sorted(BUSINESS)))(
    lambda s: _key_counts(s.business))


def _key_counts(tables):
    out = None
    for name in sorted(tables):
        one = tables[name].agg(
            F.lit(name).alias("table_name"), F.count("*").alias("row_count"),
            F.countDistinct(BUSINESS[name].names[0]).alias("keys"),
        )
        out = one if out is None else out.unionByName(one)
    return out


# Collection

_RULES = """(EventLog = 'Application' AND EventLevel IN (1, 2, 3{wide})) OR (EventLog = 'System'
  AND EventLevel IN (1, 2, 3)) OR (EventLog = 'Application' AND Source IN ('MSSQLSERVER', 'MSSQL$SQLEXPRESS'))"""

query("src04_collection_filter", over("log") + f"""SELECT TimeGenerated, Source, EventLog, EventLevel FROM log
  WHERE {_RULES.format(wide=', 4')}""")(
    lambda s: c.collect_events(s.log).select("TimeGenerated", "Source", "EventLog", "EventLevel"))

query("src04_narrow_collection_filter", over("log") + f"""SELECT TimeGenerated, Source, EventLog, EventLevel FROM log
  WHERE {_RULES.format(wide='')}""")(
    lambda s: c.collect_events(s.log, c.NARROW_EVENT_RULES).select(
        "TimeGenerated", "Source", "EventLog", "EventLevel"))


def _parsed_feed(s):
    return s.feed.withColumns(c.parse_counter_path("counter_path"))


_ALLOWED = "regexp_extract(props, '([0-9]+)', 1)::int >= 10"

query("src05_counter_paths", over("perf") + """SELECT p.TimeGenerated, p.ObjectName, p.InstanceName, CASE WHEN regexp_extract(e.props, '([0-9]+)', 1)::int < 10
  THEN 'Unlisted Counter' ELSE p.CounterName END AS CounterName FROM perf p JOIN events e
  ON e.ts = p.TimeGenerated""")(
    lambda s: _parsed_feed(s).select("TimeGenerated", "ObjectName", "InstanceName", "CounterName"))

query("src05_allowed_counters", over("perf") + f"""SELECT p.TimeGenerated, p.ObjectName, p.CounterName,
  p.CounterValue FROM perf p JOIN events e ON e.ts = p.TimeGenerated WHERE {_ALLOWED}""")(
    lambda s: c.collect_counters(s.feed).select("TimeGenerated", "ObjectName", "CounterName", "CounterValue"))

query("src05_allowed_pairs", over("perf") + """SELECT * FROM perf WHERE (ObjectName = 'Processor'
  AND CounterName = '% Processor Time') OR (ObjectName = 'MSSQL$SQLEXPRESS:Locks'
  AND CounterName IN ('Lock Waits/sec', 'Average Wait Time (ms)'))""")(
    lambda s: c.allow_counters(s.perf, (
        ("Processor", "% Processor Time"), ("MSSQL$SQLEXPRESS:Locks", "Lock Waits/sec"),
        ("MSSQL$SQLEXPRESS:Locks", "Average Wait Time (ms)"))))

query("src06_minute_samples", over("perf") + """SELECT Computer, ObjectName, CounterName, InstanceName,
  time_bucket(interval 60 second, TimeGenerated) AS interval_start, max(TimeGenerated) AS TimeGenerated,
  arg_max(CounterValue, TimeGenerated) AS CounterValue FROM perf GROUP BY 1, 2, 3, 4, 5""")(
    lambda s: c.sample(s.perf))

query("src06_hour_samples", over("perf") + """SELECT ObjectName, CounterName,
  time_bucket(interval 1 hour, TimeGenerated) AS interval_start, max(TimeGenerated) AS TimeGenerated,
  arg_max(CounterValue, TimeGenerated) AS CounterValue FROM perf GROUP BY 1, 2, 3""")(
    lambda s: c.sample(s.perf, "1 hour", ("ObjectName", "CounterName")))

_KIND = "CASE WHEN event_type IN ('error', 'view') THEN 'Event' ELSE 'Perf' END"


@query("src07_route_feed", f"""SELECT {_KIND} AS destination, count(*) AS row_count,
  cast(sum(event_id) as bigint) AS id_sum FROM events GROUP BY 1""")
def _src07(s):
    mixed = s.table("events").withColumn("kind", F.expr(_KIND))
    parts = [
        rows.agg(F.lit(name).alias("destination"), F.count("*").alias("row_count"),
                 F.sum("event_id").alias("id_sum"))
        for name, rows in c.route(mixed).items()
    ]
    return parts[0].unionByName(parts[1])


query("src08_slow_capture", over("captured") + """SELECT ts, event, duration, sql_text, database_name, username,
  client_app_name, query_hash, query_plan_hash FROM captured WHERE duration > 2000000
  AND event = 'sql_batch_completed' UNION ALL SELECT ts, event, duration, sql_text, database_name, username,
  client_app_name, query_hash, query_plan_hash FROM captured WHERE duration > 2000000 AND event = 'rpc_completed'
  """)(lambda s: c.capture_slow(s.captured))

query("src09_runtime_stats", over("captured") + """SELECT query_hash, time_bucket(interval 5 minute, ts)
  AS interval_start, count(*) AS executions, cast(sum(duration) as double) / count(*) AS avg_duration,
  max(duration) AS max_duration FROM captured GROUP BY 1, 2""")(lambda s: c.runtime_stats(s.captured))

_COUNTED = ("customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier")

query("src10_table_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _COUNTED))(
    lambda s: readers.table_counts({t: s.table(t) for t in _COUNTED}))

query("src11_retention", f"""SELECT * FROM events WHERE ts >= timestamp '{AS_OF}' - interval 7 day
  AND ts <= timestamp '{AS_OF}'""")(
    lambda s: c.retain(s.table("events"), "ts", AS_OF, 7))


# Sinks

query("snk01_result_page", "SELECT * FROM events ORDER BY ts DESC LIMIT 50")(
    lambda s: writers.result_page(s.table("events").orderBy(F.col("ts").desc())))


@query("snk02_append_rows", """SELECT customer_id, count(*) AS copies FROM (
  SELECT c_custkey AS customer_id FROM customer UNION ALL SELECT c_custkey FROM customer WHERE c_acctbal < 0)
  GROUP BY 1""")
def _snk02(s):
    path = fresh_path(s.spark, "append")
    customers = s.table("customer")
    keys = F.col("c_custkey").alias("customer_id")
    writers.append(customers.select(keys), path, BUSINESS["customers"])
    writers.append(customers.filter("c_acctbal < 0").select(keys), path, BUSINESS["customers"])
    back = readers.read_table(s.spark, path, BUSINESS["customers"])
    return back.groupBy("customer_id").agg(F.count("*").alias("copies"))


@query("snk02_daily_log_folders", """SELECT cast(cast(ts as date) as varchar) AS event_date, count(*) AS row_count,
  count(DISTINCT event_id) AS ids FROM events WHERE ts >= timestamp '2024-01-25' GROUP BY 1""")
def _snk02_log(s):
    path = fresh_path(s.spark, "log")
    writers.write_log(s.table("events"), path, "ts")
    kept = writers.drop_expired(s.spark.read.parquet(path), "2024-01-31", 6)
    return kept.groupBy("event_date").agg(
        F.count("*").alias("row_count"), F.countDistinct("event_id").alias("ids")
    )


def _indexed(s, rows, folder, columns):
    path, index = fresh_path(s.spark, folder), fresh_path(s.spark, f"{folder}-index")
    rows.write.parquet(path)
    textindex.index_files(s.spark, path, columns, index)
    return lambda *pairs: textindex.search(s.spark, path, index, pairs)


@query("flt17_indexed_patterns", """SELECT doc_id, lang FROM documents
  WHERE text ILIKE '%license%' OR text ILIKE '%email%' OR source ILIKE '%forum%'""")
def _flt17_indexed(s):
    docs = s.table("documents").select("doc_id", "lang", "source", "text").repartition(16, "doc_id")
    search = _indexed(s, docs, "texts", ["text", "source"])
    return search(("text", "%license%"), ("text", "%email%"), ("source", "%forum%")).select("doc_id", "lang")


@query("flt09_indexed_messages", over("log") + """SELECT Computer, TimeGenerated, RenderedDescription FROM log
  WHERE RenderedDescription ILIKE '%deadlock%'""")
def _flt09_indexed(s):
    rows = s.log.select("Computer", "TimeGenerated", "RenderedDescription").repartition(16, "Computer")
    return _indexed(s, rows, "messages", ["RenderedDescription"])(("RenderedDescription", "%deadlock%"))


@query("snk03_temp_snapshot", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _snk03(s):
    view = f"snapshot_{uuid.uuid4().hex}"
    s.table("orders").createOrReplaceTempView(view)
    out = s.spark.sql(f"SELECT o_orderstatus, count(*) AS n FROM {view} GROUP BY o_orderstatus")
    s.spark.catalog.dropTempView(view)
    return out


# Snapshot transforms

query("snp01_update_first_five", """SELECT o_orderkey AS claim_id, CASE WHEN b THEN 'Approved' ELSE o_orderstatus END
  AS status, cast(CASE WHEN b THEN cast(cast(o_totalprice as decimal(12,2)) * 0.85 as decimal(12,2)) END as double)
  AS approved_amount, CASE WHEN b THEN '2001-08-02' END AS processed_date FROM (SELECT *, o_orderkey IN (
  SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 5) AS b FROM orders)""")(
    lambda s: snap.approve_claims(
        s.table("orders").select(
            F.col("o_orderkey").alias("claim_id"), F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("claim_amount"),
            F.lit(None).cast("decimal(12,2)").alias("approved_amount"),
            F.lit(None).cast("date").alias("processed_date")),
        "2001-08-02", 5, "O").select("claim_id", "status", "approved_amount", "processed_date"))


@query("snp02_update_from_join", """SELECT c_custkey, CASE WHEN n IS NOT NULL THEN top ELSE c_acctbal END
  AS c_acctbal FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM orders
  WHERE o_orderstatus = 'P' GROUP BY 1) ON c_custkey = o_custkey""")
def _snp02(s):
    tops = (
        s.table("orders").filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_totalprice").alias("top"))
    )
    return update_from(s.table("customer").select("c_custkey", "c_acctbal"), tops, "c_custkey", {"c_acctbal": "top"})


@query("snp03_insert_with_defaults", """SELECT o_orderkey AS policy_id, 'Monthly' AS payment_freq,
  timestamp '2026-04-16 10:00:00' AS created_at, o_orderstatus AS status FROM orders""")
def _snp03(s):
    batch = s.bare_policies.select("policy_id", "status")
    full = conform(batch, BUSINESS["policies"], snap.policy_defaults("2026-04-16 10:00:00"))
    return full.select("policy_id", "payment_freq", F.col("created_at").cast("timestamp_ntz").alias("created_at"),
                       "status")


query("snp04_generated_references", over("transactions", "policies") + """, batch AS (
  SELECT policy_id, annual_premium FROM policies WHERE status = 'P'
  ORDER BY md5(concat(cast(policy_id as varchar), 'run2')), policy_id LIMIT 10)
  SELECT transaction_ref, policy_id, cast(amount as double) AS amount FROM transactions UNION ALL
  SELECT concat('TXN20011105SIM', right(concat('000', cast(row_number() OVER (ORDER BY policy_id) as varchar)), 3)),
  policy_id, cast(cast(annual_premium / 12 as decimal(12,2)) as double) FROM batch""")(
    lambda s: snap.insert_rows(
        s.business["transactions"], snap.payment_batch(s.bare_policies, "2001-11-05", 10, "P", "run2")
    ).select("transaction_ref", "policy_id", "amount"))


@query("snp05_replace_table", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def _snp05(s):
    path = fresh_path(s.spark, "replace")
    writers.replace(s.table("region"), path)
    writers.replace(s.table("nation"), path)
    return s.spark.read.parquet(path)


query("snp06_surrogate_keys", """SELECT c_custkey, cast((SELECT max(o_orderkey) FROM orders)
  + row_number() OVER (ORDER BY c_custkey) as bigint) AS o_orderkey FROM customer""")(
    lambda s: snap.assign_keys(s.table("orders"), s.table("customer").select("c_custkey"), "o_orderkey", "c_custkey",
                               fresh_path(s.spark, "numbered")))


# What a relational server would enforce

_ORPHANS = """SELECT '{child}.{key} -> {parent}.{to}' AS check_name, count(DISTINCT {key}) AS bad_keys,
  count(*) AS bad_rows FROM {rows} WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {to} FROM {parent})"""
_OUTSIDE = """SELECT '{table}.{key}' AS check_name, count(DISTINCT {key}) AS bad_keys, count(*) AS bad_rows
  FROM {rows} WHERE {key} NOT IN ({values})"""
_AGENT_OF = "(SELECT *, customer_id % 15 AS preferred_agent_id FROM customers)"
_PAID = "CASE policy_id % 4 WHEN 0 THEN 'Weekly' WHEN 1 THEN 'Monthly' WHEN 2 THEN 'Annually' END"
_FREQUENCY = f"(SELECT *, {_PAID} AS payment_freq FROM policies)"


def _orphans(child, key, parent, to, rows=None):
    return _ORPHANS.format(child=child, key=key, parent=parent, to=to, rows=rows or child)


def _outside(table, key, values, rows=None):
    return _OUTSIDE.format(table=table, key=key, values=values, rows=rows or table)


_CHECKS = " UNION ALL ".join([
    _orphans("customers", "preferred_agent_id", "agents", "agent_id", _AGENT_OF),
    _orphans("policies", "customer_id", "customers", "customer_id"),
    _orphans("policies", "package_id", "packages", "package_id"),
    _orphans("policies", "agent_id", "agents", "agent_id"),
    _orphans("claims", "policy_id", "policies", "policy_id"),
    _orphans("transactions", "policy_id", "policies", "policy_id"),
    _orphans("beneficiaries", "policy_id", "policies", "policy_id"),
    _outside("packages", "category", "'Life', 'Health', 'Auto', 'Property', 'Travel'"),
    _outside("policies", "status", "'Active', 'Expired', 'Cancelled', 'Pending', 'Lapsed'"),
    _outside("policies", "payment_freq", "'Monthly', 'Quarterly', 'Annually'", _FREQUENCY),
    _outside("claims", "status", "'Submitted', 'UnderReview', 'Approved', 'Rejected', 'Paid', 'Appealed'"),
    _outside("transactions", "transaction_type", "'PremiumPayment', 'ClaimPayout', 'Refund', 'Adjustment', 'Penalty'"),
    _outside("transactions", "payment_method", "'GIRO', 'CreditCard', 'PayNow', 'Cash', 'BankTransfer'"),
    _outside("transactions", "status", "'Completed', 'Pending', 'Failed', 'Reversed'"),
])


@query("dq01_constraint_checks", over("customers", "policies", "packages", "agents", "claims", "transactions",
                                      "beneficiaries") + _CHECKS)
def _dq01(s):
    return dq.check_tables({
        **s.business,
        "customers": s.business["customers"].selectExpr("*", "customer_id % 15 AS preferred_agent_id"),
        "policies": s.policies.selectExpr("*", f"{_PAID} AS payment_freq"),
    })


query("dq01_orphan_keys", """SELECT l_partkey AS key_value, count(*) AS rows FROM lineitem
  WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 25) GROUP BY 1""")(
    lambda s: dq.fk_orphans(s.table("lineitem"), s.table("part").filter("p_size > 25"), "l_partkey", "p_partkey"))

query("dq01_duplicate_keys", """SELECT l_partkey AS key_value, count(*) AS rows FROM lineitem GROUP BY 1
  HAVING count(*) > 1""")(lambda s: dq.duplicate_keys(s.table("lineitem"), "l_partkey"))

