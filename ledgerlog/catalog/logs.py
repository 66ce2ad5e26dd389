"""Log questions, message parsing and insights over ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.messages import deadlock_tables, message_facts, parse_duration, parse_took
from ..functions.timewin import between_span
from ..plans import insights as q
from ..plans import logs as p
from .bindings import over
from .registry import query

AS_OF = "2024-01-22 15:00:00"
DAY_START, DAY_END = "2024-01-30 00:00:00", "2024-01-31 00:00:00"
EVENING = "2024-01-30 18:00:00"

LOG = over("log")
PERF = over("perf")
_AVG = "cast(sum(cast(CounterValue as decimal(18,4))) as double) / count(CounterValue)"
_HOUR = "time_bucket(interval 1 hour, TimeGenerated)"
_DETAIL = "TimeGenerated, Source, EventID, RenderedDescription"
_DAY_AGO = f"TimeGenerated > timestamp '{AS_OF}' - interval 24 hour AND TimeGenerated <= timestamp '{AS_OF}'"
_WEEK_AGO = _DAY_AGO.replace("24 hour", "7 day")
_SLOWEST = (
    "SELECT TimeGenerated, try_cast(nullif(regexp_extract(RenderedDescription, "
    "'took (-?[0-9]+(\\.[0-9]+)?) seconds', 1), '') as double) AS Duration, RenderedDescription FROM log "
    f"WHERE {_DAY_AGO} AND RenderedDescription ILIKE '%slow query warning%' "
    "ORDER BY Duration DESC NULLS LAST, TimeGenerated DESC, RenderedDescription LIMIT 5"
)


query("l01_errors_on_date", LOG + f"""SELECT {_DETAIL} FROM log
  WHERE TimeGenerated BETWEEN timestamp '{DAY_START}' AND timestamp '{DAY_END}' AND EventLevelName = 'Error'""")(
    lambda s: p.l01(s.log, DAY_START, DAY_END))

query("l02_latest_in_hour", LOG + """SELECT TimeGenerated, Source, EventLevelName, RenderedDescription FROM log
  WHERE TimeGenerated BETWEEN timestamp '2024-01-20 12:00:00' AND timestamp '2024-01-20 13:00:00'
  ORDER BY TimeGenerated DESC LIMIT 10""")(lambda s: p.l02(s.log, "2024-01-20 12:00:00"))

query("l03_sql_errors_recent", LOG + f"""SELECT {_DETAIL} FROM log
  WHERE {_DAY_AGO.replace('24 hour', '6 hour')} AND EventLevelName = 'Error'
  AND contains(lower(Source), 'mssql')""")(lambda s: p.l03(s.log, AS_OF))

L04_SQL = PERF + f"""SELECT {_HOUR} AS TimeGenerated, {_AVG} AS AvgCPU FROM perf
  WHERE TimeGenerated BETWEEN timestamp '{AS_OF}' - interval 2 day AND timestamp '{AS_OF}' - interval 1 day
  AND ObjectName = 'Processor' AND CounterName = '% Processor Time' AND InstanceName = '_Total' GROUP BY 1"""
query("l04_cpu_trend_yesterday", L04_SQL)(lambda s: p.l04(s.perf, AS_OF))

query("l05_connections_in_range", PERF + f"""SELECT {_HOUR} AS TimeGenerated, max(CounterValue) AS MaxConnections,
  {_AVG} AS AvgConnections FROM perf
  WHERE TimeGenerated BETWEEN timestamp '2024-01-10' AND timestamp '2024-01-15'
  AND ObjectName = 'MSSQL$SQLEXPRESS:General Statistics' AND CounterName = 'User Connections' GROUP BY 1""")(
    lambda s: p.l05(s.perf, "2024-01-10", "2024-01-15"))

query("l06_week_by_source", LOG + f"""SELECT Source, EventLevelName, count(*) AS "Count" FROM log
  WHERE TimeGenerated > timestamp '2024-01-21' AND TimeGenerated <= timestamp '{AS_OF}'
  AND EventLevelName IN ('Error', 'Warning') GROUP BY ALL""")(lambda s: p.l06(s.log, AS_OF))

query("l07_disk_free_trend", PERF + f"""SELECT {_HOUR} AS TimeGenerated, {_AVG} AS AvgFreeSpace FROM perf
  WHERE {_DAY_AGO} AND ObjectName = 'LogicalDisk' AND CounterName = '% Free Space' AND InstanceName = '_Total'
  GROUP BY 1""")(lambda s: p.l07(s.perf, AS_OF))

query("l08_today_by_level", LOG + f"""SELECT EventLevelName, Source, count(*) AS "Count" FROM log
  WHERE TimeGenerated > timestamp '2024-01-30' AND TimeGenerated <= timestamp '{EVENING}' GROUP BY ALL""")(
    lambda s: p.l08(s.log, EVENING))

query("l09_deadlock_errors", LOG + f"""SELECT {_DETAIL} FROM log WHERE {_DAY_AGO} AND EventLevelName = 'Error'
  AND contains(lower(RenderedDescription), 'deadlock')""")(lambda s: p.l09(s.log, AS_OF))

query("l10_deadlock_messages", LOG + f"""SELECT TimeGenerated, RenderedDescription FROM log WHERE {_DAY_AGO}
  AND contains(lower(RenderedDescription), 'deadlock')""")(lambda s: p.l10(s.log, AS_OF))

query("l11_slowest_queries", LOG + _SLOWEST)(lambda s: p.l11(s.log, AS_OF))

query("l12_slow_query_errors", LOG + f"""SELECT TimeGenerated, Source, RenderedDescription FROM log
  WHERE {_DAY_AGO} AND EventLevelName = 'Error' AND contains(lower(RenderedDescription), 'slow query')""")(
    lambda s: p.l12(s.log, AS_OF))

query("l13_slow_or_deadlock", LOG + f"""SELECT TimeGenerated, RenderedDescription FROM log WHERE {_DAY_AGO}
  AND (RenderedDescription ILIKE '%slow query warning%' OR RenderedDescription ILIKE '%deadlock%')""")(
    lambda s: p.l13(s.log, AS_OF))

query("v01_error_summary", LOG + f"""SELECT Source, EventID, count(*) AS "Count" FROM log
  WHERE {_DAY_AGO} AND EventLevelName = 'Error' GROUP BY ALL""")(lambda s: p.v01(s.log, AS_OF, "24h"))

query("v02_error_details", LOG + f"""SELECT {_DETAIL} FROM log WHERE {_DAY_AGO} AND EventLevelName = 'Error'""")(
    lambda s: p.v02(s.log, AS_OF, "24h"))

query("v03_recent_deadlocks", LOG + f"""SELECT TimeGenerated, Source, RenderedDescription FROM log
  WHERE {_DAY_AGO} AND RenderedDescription ILIKE '%deadlock%'""")(lambda s: p.v03(s.log, AS_OF, "24h"))

query("v04_recent_slow_queries", LOG + f"""SELECT TimeGenerated, Source, RenderedDescription FROM log
  WHERE {_DAY_AGO} AND RenderedDescription ILIKE '%slow query%'""")(lambda s: p.v04(s.log, AS_OF, "24h"))

query("v05_recent_slowest", LOG + _SLOWEST.replace("24 hour", "12 hour"))(lambda s: p.v05(s.log, AS_OF, "12h"))

query("v06_mean_by_counter", PERF + f"""SELECT ObjectName, CounterName, {_AVG} AS "avg_CounterValue" FROM perf
  WHERE ObjectName ILIKE '%mssql%' GROUP BY ALL""")(lambda s: p.v06(s.perf))

query("v07_samples_by_counter", PERF + """SELECT ObjectName, CounterName, count(*) AS count_ FROM perf
  WHERE ObjectName ILIKE '%mssql%' GROUP BY ALL""")(lambda s: p.v07(s.perf))

query("v08_levels_of_source", LOG + f"""SELECT EventLevelName, count(*) AS count_ FROM log
  WHERE Source = 'MSSQL$error' AND {_DAY_AGO} GROUP BY ALL""")(
    lambda s: p.v08(s.log, AS_OF, "MSSQL$error", "24h"))

query("v09_all_slow_or_deadlock", LOG + """SELECT TimeGenerated, RenderedDescription FROM log
  WHERE RenderedDescription ILIKE '%slow query%' OR RenderedDescription ILIKE '%deadlock%'""")(
    lambda s: p.v09(s.log))

query("v10_count_by_level", LOG + "SELECT EventLevelName, count(*) AS count_ FROM log GROUP BY ALL")(
    lambda s: p.v10(s.log))

query("v10_take_five", LOG + """SELECT TimeGenerated, Source, EventLevelName FROM log
  ORDER BY TimeGenerated DESC LIMIT 5""")(lambda s: p.v10_take(s.log))

_NEWEST = (
    f"newest AS (SELECT * FROM log WHERE EventLog = 'Application' AND TimeGenerated <= timestamp '{AS_OF}' "
    "ORDER BY TimeGenerated DESC LIMIT {n})"
)

query("v11_levels_of_newest", LOG.rstrip() + ", " + _NEWEST.format(n=200) + f"""
  SELECT EventLevelName, count(*) AS "Count" FROM newest WHERE Source LIKE 'MSSQL%' AND {_DAY_AGO}
  GROUP BY ALL""")(lambda s: p.v11_levels(s.log, AS_OF))

query("v11_previews_of_newest", LOG.rstrip() + ", " + _NEWEST.format(n=200) + f"""
  SELECT TimeGenerated, EventLevelName, concat(left(RenderedDescription, 150), '...') AS Preview FROM newest
  WHERE Source LIKE 'MSSQL%' AND {_DAY_AGO} ORDER BY TimeGenerated DESC LIMIT 5""")(
    lambda s: p.v11_previews(s.log, AS_OF))

query("v12_slow_among_newest", LOG.rstrip() + ", " + _NEWEST.format(n=20) + f"""
  SELECT count(*) AS found FROM newest WHERE RenderedDescription ILIKE '%slow query%' AND {_DAY_AGO}""")(
    lambda s: p.v12(s.log, AS_OF, ago="24h"))

query("v13_sql_errors_in_window", LOG + """SELECT TimeGenerated, EventID, RenderedDescription FROM log
  WHERE TimeGenerated BETWEEN timestamp '2024-01-20' AND timestamp '2024-01-21' AND EventLevelName = 'Error'
  AND Source ILIKE '%mssql%'""")(
    lambda s: p.v13(s.log, between_span("2024-01-20", "2024-01-21")))


# Message parsing over every message

_ANY = "'(?i)(?:took|elapsed|exceeded|duration:|rolled back after) (-?[0-9]+(?:\\.[0-9]+)?) seconds'"
_FIRST = "try_cast(nullif(regexp_extract(RenderedDescription, {pattern}, 1), '') as {kind})"
_STRICT_SQL = _FIRST.format(pattern="'took (-?[0-9]+(?:\\.[0-9]+)?) seconds'", kind="double")
_ANY_SQL = _FIRST.format(pattern=_ANY, kind="double")
_TABLES_SQL = (
    "regexp_extract_all(RenderedDescription, '(?i)(?:lock on table|on table|lock on|transaction on) (\\w+)', 1)"
)

query("txt01_took_seconds", LOG + f"SELECT TimeGenerated, {_STRICT_SQL} AS seconds FROM log")(
    lambda s: s.log.select("TimeGenerated", parse_took("RenderedDescription").alias("seconds")))

query("txt02_any_duration", LOG + f"SELECT TimeGenerated, {_ANY_SQL} AS seconds FROM log")(
    lambda s: s.log.select("TimeGenerated", parse_duration("RenderedDescription").alias("seconds")))

query("txt03_deadlock_tables", LOG + f"""SELECT DISTINCT TimeGenerated, unnest({_TABLES_SQL}) AS table_name
  FROM log WHERE RenderedDescription LIKE '%DEADLOCK%'""")(
    lambda s: s.log.filter(F.col("RenderedDescription").contains("DEADLOCK")).select(
        "TimeGenerated", F.explode(deadlock_tables("RenderedDescription")).alias("table_name")))


def _fact(name: str, pattern: str, kind: str) -> str:
    return f"{_FIRST.format(pattern=repr(pattern), kind=kind)} AS {name}"


query("txt04_message_facts", LOG + "SELECT TimeGenerated, " + ", ".join([
    _fact("rows_scanned", r"([0-9]+) rows scanned", "bigint"),
    _fact("index_seeks", r"([0-9]+) index seek", "bigint"),
    _fact("query_hash", r"Query hash: (0x[0-9A-Fa-f]+)", "varchar"),
    _fact("process_id", r"Process ([0-9]+)", "bigint"),
]) + " FROM log")(
    lambda s: s.log.select("TimeGenerated", message_facts("RenderedDescription").alias("f")).select(
        "TimeGenerated", "f.rows_scanned", "f.index_seeks", "f.query_hash", "f.process_id"))


# Documented insights

_CATEGORY = """CASE WHEN EventID = 18456 THEN 'failed login' WHEN EventID = 3041 THEN 'backup failure'
  WHEN EventID = 208 THEN 'missing object' WHEN RenderedDescription ILIKE '%deadlock%' THEN 'deadlock'
  WHEN RenderedDescription ILIKE '%slow query%' THEN 'slow query'
  WHEN RenderedDescription ILIKE '%timeout%' THEN 'timeout'
  WHEN RenderedDescription ILIKE '%login failed%' THEN 'failed login'
  WHEN RenderedDescription ILIKE '%disk space%' THEN 'disk space'
  WHEN RenderedDescription ILIKE '%log full%' THEN 'log full'
  WHEN RenderedDescription ILIKE '%constraint violation%' THEN 'constraint violation'
  WHEN EventID = 911 THEN 'missing database' ELSE 'other' END"""

query("q01_error_summary_total", LOG + f"""SELECT Source, EventID, count(*) AS "Count",
  cast(sum(count(*)) OVER () as bigint) AS total FROM log WHERE {_DAY_AGO} AND EventLevelName = 'Error'
  GROUP BY Source, EventID""")(lambda s: q.q01(s.log, AS_OF, "24h"))

query("q02_missing_databases", LOG + f"""SELECT regexp_extract(RenderedDescription, 'Database .(\\w+). does', 1)
  AS database_name, count(*) AS "Count" FROM log WHERE {_WEEK_AGO} AND EventID = 911 GROUP BY 1""")(lambda s: q.q02(s.log, AS_OF, "7d"))

query("q03_failed_logins_by_user", LOG + f"""SELECT regexp_extract(RenderedDescription, 'user .(\\w+).', 1)
  AS login_user, count(*) AS "Count" FROM log WHERE {_WEEK_AGO} AND EventID = 18456 GROUP BY 1""")(lambda s: q.q03(s.log, AS_OF, "7d"))

query("q04_deadlock_or_timeout", LOG + f"""SELECT {_DETAIL} FROM log
  WHERE {_WEEK_AGO} AND (RenderedDescription ILIKE '%deadlock%' OR RenderedDescription ILIKE '%timeout%')""")(
    lambda s: q.q04(s.log, AS_OF, "7d"))

query("q05_failed_backups", LOG + f"""SELECT TimeGenerated, Source, RenderedDescription FROM log
  WHERE {_WEEK_AGO} AND EventID = 3041""")(lambda s: q.q05(s.log, AS_OF, "7d"))

query("q06_login_bursts", LOG + f"""SELECT Computer, time_bucket(interval 1 day, TimeGenerated) AS window_start,
  count(*) AS attempts FROM log WHERE {_WEEK_AGO} AND EventID = 18456 GROUP BY ALL HAVING count(*) >= 2""")(
    lambda s: q.q06(s.log, AS_OF, "1 day", 2, "7d"))

query("q06_login_bursts_default", LOG + f"""SELECT 'vm' AS Computer, time_bucket(interval 10 minute, TimeGenerated) AS window_start,
  count(*) AS attempts FROM log WHERE {_WEEK_AGO.replace('7 day', '30 day')} AND EventID = 18456 GROUP BY ALL
  HAVING count(*) >= 3""")(
    lambda s: q.q06(s.log.withColumn("Computer", F.lit("vm")), AS_OF, ago="90d"))

query("q07_most_critical", LOG + f"""SELECT category, "Count", "Count" * CASE WHEN category IN
  ('deadlock', 'disk space', 'log full') THEN 5 WHEN category IN ('backup failure', 'failed login') THEN 4
  WHEN category IN ('timeout', 'slow query') THEN 3
  WHEN category IN ('missing database', 'missing object', 'constraint violation') THEN 2 ELSE 1 END AS score
  FROM (SELECT {_CATEGORY} AS category, count(*) AS "Count" FROM log WHERE {_WEEK_AGO} GROUP BY 1)
  ORDER BY score DESC, category LIMIT 3""")(lambda s: q.q07(s.log, AS_OF, 3, "7d"))

query("q08_disk_space", LOG + f"""SELECT TimeGenerated, Source, RenderedDescription FROM log
  WHERE {_WEEK_AGO} AND RenderedDescription ILIKE '%disk space%'""")(lambda s: q.q08(s.log, AS_OF, "7d"))

query("q09_day_timeline", LOG + f"""SELECT {_HOUR} AS hour, {_CATEGORY} AS category, count(*) AS "Count" FROM log
  WHERE TimeGenerated > timestamp '2024-01-30' AND TimeGenerated <= timestamp '{EVENING}' GROUP BY 1, 2""")(
    lambda s: q.q09(s.log, EVENING))

query("q10_deadlock_details", LOG + f"""SELECT TimeGenerated,
  {_fact('process_id', r'Process ([0-9]+)', 'bigint')},
  array_to_string({_TABLES_SQL}, ', ') AS tables, {_ANY_SQL} AS seconds FROM log
  WHERE {_WEEK_AGO} AND RenderedDescription ILIKE '%deadlock%'""")(lambda s: q.q10(s.log, AS_OF, "7d"))

query("q11_slowest_any_phrase", LOG + f"""SELECT TimeGenerated, {_ANY_SQL} AS seconds, RenderedDescription FROM log
  WHERE {_WEEK_AGO} AND RenderedDescription ILIKE '%slow query warning%'
  ORDER BY seconds DESC NULLS LAST, TimeGenerated DESC LIMIT 5""")(lambda s: q.q11(s.log, AS_OF, ago="7d"))

query("q12_tables_in_deadlocks", LOG + f"""SELECT table_name, count(*) AS messages FROM (
  SELECT DISTINCT TimeGenerated, unnest({_TABLES_SQL}) AS table_name FROM log
  WHERE {_WEEK_AGO} AND RenderedDescription ILIKE '%deadlock%') GROUP BY 1""")(lambda s: q.q12(s.log, AS_OF, "7d"))

query("q13_recommendations", LOG + f"""SELECT recommendation, count(*) AS messages FROM (
  SELECT trim(unnest(string_split(RenderedDescription, '.'))) AS recommendation FROM log WHERE {_WEEK_AGO})
  WHERE recommendation ILIKE 'consider %' OR recommendation ILIKE '% recommended' GROUP BY 1""")(
    lambda s: q.q13(s.log, AS_OF, "7d"))

query("q14_full_table_scans", LOG + f"""SELECT TimeGenerated,
  {_fact('rows_scanned', r'([0-9]+) rows scanned', 'bigint')}, {_ANY_SQL} AS seconds, RenderedDescription FROM log
  WHERE {_WEEK_AGO} AND RenderedDescription ILIKE '%full table scan%'""")(lambda s: q.q14(s.log, AS_OF, "7d"))

query("q15_error_categories", LOG + f"""SELECT {_CATEGORY} AS category, count(*) AS "Count" FROM log
  WHERE {_WEEK_AGO} GROUP BY 1""")(lambda s: q.q15(s.log, AS_OF, "7d"))
