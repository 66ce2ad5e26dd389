"""Questions over the ``Event`` and ``Perf`` tables (L-01..L-13, V-01..V-13).

The time predicate comes first and holds bare columns and literals, so it is pushed
to the scan; on a table kept in day folders it prunes the folders too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.messages import parse_took
from ..functions.stats import exact_avg
from ..functions.text import contains_any, contains_ci, preview
from ..functions.timewin import (
    Span,
    When,
    between_span,
    during,
    hour_span,
    since_span,
    today_span,
    week_span,
    yesterday_span,
)
from ..operators.aggregates import bin_agg, count_by, mean_by
from ..operators.topk import top_k

# The time column, and the words and sources of the messages.
TS = "TimeGenerated"
SLOW = "SLOW QUERY"
SLOW_WARNING = "SLOW QUERY WARNING"
DEADLOCK = "DEADLOCK"
SQL_SOURCE = "MSSQL"
INSTANCE = "MSSQL$SQLEXPRESS"

DETAIL = (TS, "Source", "EventID", "RenderedDescription")
BRIEF = (TS, "Source", "RenderedDescription")


def _level(level: str) -> Column:
    return F.col("EventLevelName") == level


def _counter(obj: str, counter: str, instance: str | None = None) -> Column:
    cond = (F.col("ObjectName") == obj) & (F.col("CounterName") == counter)
    return cond & (F.col("InstanceName") == instance) if instance else cond


def _newest(df: DataFrame) -> DataFrame:
    """Newest first. A hash of the row follows, so a range partition can be cut inside one instant."""
    return df.orderBy(F.col(TS).desc(), F.xxhash64(*(c for c in df.columns if c != TS)))


def l01(events: DataFrame, start: When, end: When, level: str = "Error") -> DataFrame:
    """Errors on a date."""
    return _newest(during(events, TS, between_span(start, end)).filter(_level(level)).select(*DETAIL))


def l02(events: DataFrame, at: When, around: bool = False, k: int = 10) -> DataFrame:
    """Latest log rows in an hour."""
    rows = during(events, TS, hour_span(at, around)).select(
        TS, "Source", "EventLevelName", "RenderedDescription"
    )
    return top_k(rows, [F.col(TS).desc(), "Source", "RenderedDescription"], k)


def l03(events: DataFrame, as_of: When, ago: str = "6h", level: str = "Error", source: str = SQL_SOURCE) -> DataFrame:
    """Database errors of the last hours."""
    rows = during(events, TS, since_span(as_of, ago)).filter(_level(level)).filter(contains_ci("Source", source))
    return _newest(rows.select(*DETAIL))


def l04(perf: DataFrame, as_of: When) -> DataFrame:
    """Hourly CPU trend of the rolling yesterday."""
    rows = during(perf, TS, yesterday_span(as_of)).filter(_counter("Processor", "% Processor Time", "_Total"))
    return bin_agg(rows, TS, "1 hour", [exact_avg("CounterValue").alias("AvgCPU")]).orderBy(TS)


def l05(perf: DataFrame, start: When, end: When) -> DataFrame:
    """Connections per hour in a range: greatest and mean in one pass."""
    rows = during(perf, TS, between_span(start, end)).filter(
        _counter(f"{INSTANCE}:General Statistics", "User Connections")
    )
    aggs = [F.max("CounterValue").alias("MaxConnections"), exact_avg("CounterValue").alias("AvgConnections")]
    return bin_agg(rows, TS, "1 hour", aggs).orderBy(TS)


def l06(events: DataFrame, as_of: When, levels: tuple[str, ...] = ("Error", "Warning")) -> DataFrame:
    """This week's warnings and errors by source."""
    rows = during(events, TS, week_span(as_of)).filter(F.col("EventLevelName").isin(*levels))
    return count_by(rows, ["Source", "EventLevelName"]).orderBy(F.col("Count").desc())


def l07(perf: DataFrame, as_of: When) -> DataFrame:
    """Hourly free disk space of the last 24 hours."""
    rows = during(perf, TS, since_span(as_of, "24h")).filter(_counter("LogicalDisk", "% Free Space", "_Total"))
    return bin_agg(rows, TS, "1 hour", [exact_avg("CounterValue").alias("AvgFreeSpace")]).orderBy(TS)


def l08(events: DataFrame, as_of: When) -> DataFrame:
    """Today's rows by level and source."""
    return count_by(during(events, TS, today_span(as_of)), ["EventLevelName", "Source"]).orderBy(F.col("Count").desc())


def l09(events: DataFrame, as_of: When, ago: str = "24h", level: str = "Error") -> DataFrame:
    """Deadlock errors."""
    rows = during(events, TS, since_span(as_of, ago)).filter(_level(level))
    return _newest(rows.filter(contains_ci("RenderedDescription", DEADLOCK)).select(*DETAIL))


def l10(events: DataFrame, as_of: When, ago: str = "24h") -> DataFrame:
    """Deadlock messages of any level."""
    rows = during(events, TS, since_span(as_of, ago)).filter(contains_ci("RenderedDescription", DEADLOCK))
    return _newest(rows.select(TS, "RenderedDescription"))


def l11(events: DataFrame, as_of: When, ago: str = "24h", k: int = 5) -> DataFrame:
    """The slowest queries by their stated seconds; messages without a number come last."""
    rows = during(events, TS, since_span(as_of, ago)).filter(contains_ci("RenderedDescription", SLOW_WARNING))
    timed = rows.select(TS, parse_took("RenderedDescription").alias("Duration"), "RenderedDescription")
    return top_k(timed, [F.col("Duration").desc_nulls_last(), F.col(TS).desc(), "RenderedDescription"], k)


def l12(events: DataFrame, as_of: When, ago: str = "24h", level: str = "Error") -> DataFrame:
    """Slow-query errors."""
    rows = during(events, TS, since_span(as_of, ago)).filter(_level(level))
    return _newest(rows.filter(contains_ci("RenderedDescription", SLOW)).select(*BRIEF))


def l13(events: DataFrame, as_of: When, ago: str = "24h") -> DataFrame:
    """Slow-query or deadlock messages."""
    rows = during(events, TS, since_span(as_of, ago)).filter(
        contains_any("RenderedDescription", [SLOW_WARNING, DEADLOCK])
    )
    return _newest(rows.select(TS, "RenderedDescription"))


def v01(events: DataFrame, as_of: When, ago: str = "30m", level: str = "Error") -> DataFrame:
    """Recent errors by source and id."""
    rows = during(events, TS, since_span(as_of, ago)).filter(_level(level))
    return count_by(rows, ["Source", "EventID"]).orderBy(F.col("Count").desc())


def v02(events: DataFrame, as_of: When, ago: str = "30m", level: str = "Error") -> DataFrame:
    """Recent errors in detail."""
    return _newest(during(events, TS, since_span(as_of, ago)).filter(_level(level)).select(*DETAIL))


def v03(events: DataFrame, as_of: When, ago: str = "30m") -> DataFrame:
    """Recent deadlocks."""
    rows = during(events, TS, since_span(as_of, ago)).filter(contains_ci("RenderedDescription", DEADLOCK))
    return _newest(rows.select(*BRIEF))


def v04(events: DataFrame, as_of: When, ago: str = "30m") -> DataFrame:
    """Recent slow queries by time."""
    rows = during(events, TS, since_span(as_of, ago)).filter(contains_ci("RenderedDescription", SLOW))
    return _newest(rows.select(*BRIEF))


def v05(events: DataFrame, as_of: When, ago: str = "30m", k: int = 5) -> DataFrame:
    """Recent slowest queries."""
    return l11(events, as_of, ago, k)


def v06(perf: DataFrame) -> DataFrame:
    """Mean of every database counter."""
    rows = perf.filter(contains_ci("ObjectName", SQL_SOURCE))
    return mean_by(rows, ["ObjectName", "CounterName"], "CounterValue").orderBy("ObjectName")


def v07(perf: DataFrame) -> DataFrame:
    """Samples per database counter."""
    rows = perf.filter(contains_ci("ObjectName", SQL_SOURCE))
    return count_by(rows, ["ObjectName", "CounterName"], "count_").orderBy(F.col("count_").desc())


def v08(events: DataFrame, as_of: When, source: str = INSTANCE, ago: str = "1h") -> DataFrame:
    """Recent rows of one source by level."""
    rows = during(events, TS, since_span(as_of, ago)).filter(F.col("Source") == source)
    return count_by(rows, ["EventLevelName"], "count_")


def v09(events: DataFrame) -> DataFrame:
    """Slow-query or deadlock messages of all time."""
    rows = events.filter(contains_any("RenderedDescription", [SLOW, DEADLOCK]))
    return _newest(rows.select(TS, "RenderedDescription"))


def v10(events: DataFrame) -> DataFrame:
    """Rows by level."""
    return count_by(events, ["EventLevelName"], "count_")


def v10_take(events: DataFrame, n: int = 5) -> DataFrame:
    """Any ``n`` rows; ordered here so that the pick is repeatable."""
    rows = events.select(TS, "Source", "EventLevelName")
    return top_k(rows, [F.col(TS).desc(), "Source"], n)


def v11_levels(events: DataFrame, as_of: When, log: str = "Application", newest: int = 200) -> DataFrame:
    """Levels of the database events among the newest rows of the last 24 hours."""
    return count_by(_recent_sql(events, as_of, log, newest), ["EventLevelName"])


def v11_previews(
    events: DataFrame, as_of: When, log: str = "Application", newest: int = 200, k: int = 5
) -> DataFrame:
    """The newest of those events, each cut to 150 characters."""
    rows = _recent_sql(events, as_of, log, newest)
    cut = rows.select(TS, "EventLevelName", preview("RenderedDescription").alias("Preview"))
    return top_k(cut, [F.col(TS).desc(), "Preview"], k)


def _newest_of_log(events: DataFrame, as_of: When, ago: str, log: str, newest: int) -> DataFrame:
    """The recent ones among the newest rows of a log.

    Newest rows are the recent ones first, so the time filter may come before the cut.
    """
    recent = during(events, TS, since_span(as_of, ago)).filter(F.col("EventLog") == log)
    return top_k(recent, [F.col(TS).desc(), "Source", "RenderedDescription"], newest)


def _recent_sql(events: DataFrame, as_of: When, log: str, newest: int) -> DataFrame:
    read = _newest_of_log(events, as_of, "24h", log, newest)
    return read.filter(F.lower("Source").startswith(SQL_SOURCE.lower()))


def v12(
    events: DataFrame, as_of: When, log: str = "Application", newest: int = 20, ago: str = "5m"
) -> DataFrame:
    """How many of the newest rows are recent slow-query messages."""
    read = _newest_of_log(events, as_of, ago, log, newest)
    return read.filter(contains_ci("RenderedDescription", SLOW)).agg(F.count("*").alias("found"))


def v13(events: DataFrame, window: Span, level: str = "Error", source: str = SQL_SOURCE) -> DataFrame:
    """Database errors in any time window, three columns."""
    rows = during(events, TS, window).filter(_level(level)).filter(contains_ci("Source", source))
    return _newest(rows.select(TS, "EventID", "RenderedDescription"))
