"""Collection rules: which events and counters are kept, sampled and routed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import exact_avg
from ..functions.text import any_of
from ..functions.timewin import ColumnLike, When, as_column, bin_start, clamp_span, during
from ..schemas import COUNTERS
from .extremum import first_of


@dataclass(frozen=True)
class EventRule:
    """Events of one log, restricted by level or by provider."""

    log: str
    levels: tuple[int, ...] = ()
    providers: tuple[str, ...] = ()

    def condition(self) -> Column:
        cond = F.col("EventLog") == self.log
        if self.levels:
            cond = cond & F.col("EventLevel").isin(*self.levels)
        if self.providers:
            cond = cond & F.col("Source").isin(*self.providers)
        return cond


# Levels are 1 Critical, 2 Error, 3 Warning, 4 Information.
DATABASE_PROVIDERS = ("MSSQLSERVER", "MSSQL$SQLEXPRESS")
EVENT_RULES = (
    EventRule("Application", levels=(1, 2, 3, 4)),
    EventRule("System", levels=(1, 2, 3)),
    EventRule("Application", providers=DATABASE_PROVIDERS),
)
NARROW_EVENT_RULES = (
    EventRule("Application", levels=(1, 2, 3)),
    EventRule("System", levels=(1, 2, 3)),
    EventRule("Application", providers=DATABASE_PROVIDERS),
)

# Kinds of captured statements and the capture threshold.
CAPTURED_KINDS = ("sql_batch_completed", "rpc_completed")
SLOW_MICROSECONDS = 2_000_000

# The counter paths an agent is told to sample.
COUNTER_PATHS = (
    r"\Processor(_Total)\% Processor Time",
    r"\Memory\Available MBytes",
    r"\LogicalDisk(_Total)\% Free Space",
    r"\MSSQL$SQLEXPRESS:General Statistics\User Connections",
    r"\MSSQL$SQLEXPRESS:SQL Statistics\Batch Requests/sec",
    r"\MSSQL$SQLEXPRESS:SQL Statistics\SQL Compilations/sec",
    r"\MSSQL$SQLEXPRESS:SQL Statistics\SQL Re-Compilations/sec",
    r"\MSSQL$SQLEXPRESS:Locks(_Total)\Lock Waits/sec",
    r"\MSSQL$SQLEXPRESS:Locks(_Total)\Average Wait Time (ms)",
    r"\MSSQL$SQLEXPRESS:Buffer Manager\Page life expectancy",
)

SERIES = ("Computer", "ObjectName", "CounterName", "InstanceName")


def collect_events(df: DataFrame, rules: Sequence[EventRule] = EVENT_RULES) -> DataFrame:
    """Rows that satisfy any rule, each once."""
    return df.filter(any_of(rule.condition() for rule in rules))


def parse_counter_path(path: ColumnLike) -> dict[str, Column]:
    r"""``\Object(Instance)\Counter`` as three columns; the instance may be absent.

    The counter name itself may end in parentheses, e.g. ``(ms)``.
    """
    path = as_column(path)
    pattern = r"^\\([^\\(]+)(?:\(([^)]*)\))?\\(.+)$"
    part = lambda i: F.nullif(F.regexp_extract(path, pattern, i), F.lit(""))
    return {"ObjectName": part(1), "InstanceName": part(2), "CounterName": part(3)}


def allow_counters(df: DataFrame, counters: Sequence[tuple[str, str]] = COUNTERS) -> DataFrame:
    """Keep the listed (object, counter) pairs; a short literal list, so a filter does it."""
    by_object: dict[str, list[str]] = {}
    for obj, counter in counters:
        by_object.setdefault(obj, []).append(counter)
    return df.filter(
        any_of(
            (F.col("ObjectName") == obj) & F.col("CounterName").isin(*names)
            for obj, names in by_object.items()
        )
    )


def collect_counters(feed: DataFrame, path: str = "counter_path", paths: Sequence[str] = COUNTER_PATHS) -> DataFrame:
    """Keep the listed counter paths and split them into columns.

    The whole path is compared before anything is parsed, so the filter is a plain
    IN list on the stored column.
    """
    return feed.filter(F.col(path).isin(*paths)).withColumns(parse_counter_path(path)).drop(path)


def sample(
    df: DataFrame, width: str = "60 seconds", series: Sequence[str] = SERIES, ts: str = "TimeGenerated",
    value: str = "CounterValue",
) -> DataFrame:
    """One row per series and interval: the latest value, of several at that time the largest."""
    binned = df.withColumn("_bin", bin_start(ts, width))
    latest = first_of(binned, [*series, "_bin"], [ts, value], [ts, value], last=True)
    return latest.select(*series, F.col("_bin").alias("interval_start"), ts, value)


def route(df: DataFrame, kind: str = "kind") -> dict[str, DataFrame]:
    """Split a mixed feed into its two destinations."""
    return {
        "Event": df.filter(F.col(kind) == "Event"),
        "Perf": df.filter(F.col(kind) == "Perf"),
    }


def capture_slow(df: DataFrame, min_us: int = SLOW_MICROSECONDS) -> DataFrame:
    """Completed statements slower than the threshold, of both kinds, in one scan."""
    return df.filter(F.col("event").isin(*CAPTURED_KINDS) & (F.col("duration") > min_us)).select(
        "ts", "event", "duration", "sql_text", "database_name", "username", "client_app_name",
        "query_hash", "query_plan_hash",
    )


def runtime_stats(df: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Executions, mean and maximum duration per query and interval."""
    return df.groupBy("query_hash", bin_start("ts", width).alias("interval_start")).agg(
        F.count("*").alias("executions"),
        exact_avg("duration", "decimal(20,0)").alias("avg_duration"),
        F.max("duration").alias("max_duration"),
    )


def retain(df: DataFrame, ts: str, as_of: When, days: int = 30) -> DataFrame:
    """Rows of the ``days`` days up to ``as_of``, both ends included; day folders are pruned."""
    return during(df, ts, clamp_span(as_of, days))
