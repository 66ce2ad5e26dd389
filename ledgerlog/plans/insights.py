"""Questions whose expected answer is documented but whose query is not (Q-01..Q-15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.messages import (
    FAILED_LOGIN,
    MISSING_DATABASE,
    advice,
    deadlock_tables,
    login_user,
    message_facts,
    missing_database,
    parse_duration,
)
from ..functions.text import contains_any, contains_ci
from ..functions.timewin import When, bin_start, during, recent_span, today_span
from ..operators.aggregates import count_by
from ..operators.topk import top_k
from .logs import DEADLOCK, SLOW_WARNING, TS, v01

# Event ids of the error kinds.
MISSING_DATABASE_ID = 911
MISSING_OBJECT_ID = 208
FAILED_LOGIN_ID = 18456
BACKUP_FAILED_ID = 3041

# Category rules in order of precedence, with the weight used to rank them.
CATEGORY_WEIGHTS = {
    "deadlock": 5,
    "disk space": 5,
    "log full": 5,
    "backup failure": 4,
    "failed login": 4,
    "timeout": 3,
    "slow query": 3,
    "missing database": 2,
    "missing object": 2,
    "constraint violation": 2,
    "other": 1,
}


def recent(events: DataFrame, as_of: When, ago: str) -> DataFrame:
    """Where every question starts: the last ``ago``, 30 days at most."""
    return during(events, TS, recent_span(as_of, ago))


def with_category(events: DataFrame) -> DataFrame:
    """Time and category of every event, the category out of its id and text.

    The text is lowered once, in a projection of its own.
    """
    lowered = events.select(TS, "EventID", F.lower("RenderedDescription").alias("_text"))
    event_id, text = F.col("EventID"), F.col("_text")
    category = (
        F.when(event_id == FAILED_LOGIN_ID, "failed login")
        .when(event_id == BACKUP_FAILED_ID, "backup failure")
        .when(event_id == MISSING_OBJECT_ID, "missing object")
        .when(text.contains("deadlock"), "deadlock")
        .when(text.contains("slow query"), "slow query")
        .when(text.contains("timeout"), "timeout")
        .when(text.contains("login failed"), "failed login")
        .when(text.contains("disk space"), "disk space")
        .when(text.contains("log full"), "log full")
        .when(text.contains("constraint violation"), "constraint violation")
        .when((event_id == MISSING_DATABASE_ID) | text.rlike(MISSING_DATABASE), "missing database")
        .otherwise("other")
    )
    return lowered.select(TS, category.alias("category"))


def _weight(name: str) -> Column:
    cases = F
    for label, weight in CATEGORY_WEIGHTS.items():
        cases = cases.when(F.col(name) == label, weight)
    return cases.otherwise(1)


def q01(events: DataFrame, as_of: When, ago: str = "30m", level: str = "Error") -> DataFrame:
    """Recent errors by source and id, each with the overall total."""
    counted = v01(events, as_of, ago, level)
    # both read the same shuffled counts
    total = counted.agg(F.sum("Count").alias("n")).scalar()
    return counted.withColumn("total", total)


def q02(events: DataFrame, as_of: When, ago: str = "24h") -> DataFrame:
    """Databases that were not found, with the number of attempts."""
    hits = recent(events, as_of, ago).filter(contains_ci("RenderedDescription", "does not exist"))
    named = hits.select(missing_database("RenderedDescription").alias("database_name"))
    return count_by(named.filter(F.col("database_name").isNotNull()), ["database_name"])


def q03(events: DataFrame, as_of: When, ago: str = "24h") -> DataFrame:
    """Failed logins by user."""
    hits = recent(events, as_of, ago).filter(F.col("EventID") == FAILED_LOGIN_ID)
    named = hits.select(login_user("RenderedDescription").alias("login_user"))
    return count_by(named, ["login_user"]).orderBy(F.col("Count").desc(), "login_user")


def q04(events: DataFrame, as_of: When, ago: str = "24h") -> DataFrame:
    """Deadlock or timeout messages."""
    return recent(events, as_of, ago).filter(contains_any("RenderedDescription", ["deadlock", "timeout"])).select(
        TS, "Source", "EventID", "RenderedDescription"
    )


def q05(events: DataFrame, as_of: When, ago: str = "24h") -> DataFrame:
    """Failed backups."""
    hits = recent(events, as_of, ago).filter(F.col("EventID") == BACKUP_FAILED_ID)
    return hits.select(TS, "Source", "RenderedDescription")


def q06(
    events: DataFrame, as_of: When, width: str = "10 minutes", threshold: int = 3, ago: str = "24h"
) -> DataFrame:
    """Computers with many failed logins in one tumbling window."""
    hits = recent(events, as_of, ago).filter(
        (F.col("EventID") == FAILED_LOGIN_ID) & F.col("RenderedDescription").rlike(FAILED_LOGIN)
    )
    return (
        hits.groupBy("Computer", bin_start(TS, width).alias("window_start"))
        .agg(F.count("*").alias("attempts"))
        .filter(F.col("attempts") >= threshold)
    )


def q07(events: DataFrame, as_of: When, k: int = 1, ago: str = "24h") -> DataFrame:
    """The most pressing category: weight times count."""
    counted = count_by(with_category(recent(events, as_of, ago)), ["category"])
    scored = counted.withColumn("score", F.col("Count") * _weight("category"))
    return top_k(scored, [F.col("score").desc(), "category"], k)


def q08(events: DataFrame, as_of: When, ago: str = "24h") -> DataFrame:
    """Disk space messages."""
    return recent(events, as_of, ago).filter(contains_ci("RenderedDescription", "disk space")).select(
        TS, "Source", "RenderedDescription"
    )


def q09(events: DataFrame, as_of: When) -> DataFrame:
    """Today's timeline by hour and category."""
    return (
        with_category(during(events, TS, today_span(as_of)))
        .groupBy(bin_start(TS, "1 hour").alias("hour"), "category")
        .agg(F.count("*").alias("Count"))
        .orderBy("hour", "category")
    )


def q10(events: DataFrame, as_of: When, ago: str = "24h") -> DataFrame:
    """Deadlocks with their tables and durations."""
    text = "RenderedDescription"
    return recent(events, as_of, ago).filter(contains_ci(text, DEADLOCK)).select(
        TS,
        message_facts(text)["process_id"].alias("process_id"),
        F.array_join(deadlock_tables(text), ", ").alias("tables"),
        parse_duration(text).alias("seconds"),
    )


def q11(events: DataFrame, as_of: When, k: int = 5, ago: str = "24h") -> DataFrame:
    """The slowest queries by whatever phrase states their seconds."""
    text = "RenderedDescription"
    hits = recent(events, as_of, ago).filter(contains_ci(text, SLOW_WARNING))
    timed = hits.select(TS, parse_duration(text).alias("seconds"), text)
    return top_k(timed, [F.col("seconds").desc_nulls_last(), F.col(TS).desc(), text], k)


def q12(events: DataFrame, as_of: When, ago: str = "24h") -> DataFrame:
    """Tables named in deadlock messages, by number of messages."""
    text = "RenderedDescription"
    hits = recent(events, as_of, ago).filter(contains_ci(text, DEADLOCK))
    named = hits.select(F.explode(deadlock_tables(text)).alias("table_name"))
    return count_by(named, ["table_name"], "messages")


def q13(events: DataFrame, as_of: When, ago: str = "24h") -> DataFrame:
    """Advice stated in messages, by number of messages."""
    hits = recent(events, as_of, ago).filter(contains_any("RenderedDescription", ["consider", "recommended"]))
    stated = hits.select(F.explode(advice("RenderedDescription")).alias("recommendation"))
    return count_by(stated, ["recommendation"], "messages")


def q14(events: DataFrame, as_of: When, ago: str = "24h") -> DataFrame:
    """Messages about full table scans."""
    text = "RenderedDescription"
    return recent(events, as_of, ago).filter(contains_ci(text, "full table scan")).select(
        TS, message_facts(text)["rows_scanned"].alias("rows_scanned"), parse_duration(text).alias("seconds"), text
    )


def q15(events: DataFrame, as_of: When, ago: str = "24h") -> DataFrame:
    """Events per category."""
    return count_by(with_category(recent(events, as_of, ago)), ["category"])
