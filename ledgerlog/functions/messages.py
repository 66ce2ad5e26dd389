"""Facts parsed out of free-text log messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timewin import ColumnLike, as_column

_NUMBER = r"(-?\d+(?:\.\d+)?)"

# The ways a message states how long something took.
STRICT_DURATION = rf"took {_NUMBER} seconds"
ANY_DURATION = rf"(?i)(?:took|elapsed|exceeded|duration:|rolled back after) {_NUMBER} seconds"
LOCKED_TABLE = r"(?i)(?:lock on table|on table|lock on|transaction on) (\w+)"
MISSING_DATABASE = r"(?i)database '?(\w+)'? does not exist"
FAILED_LOGIN = r"(?i)for user '?(\w+)"


def _number(c: ColumnLike, pattern: str, kind: str) -> Column:
    return F.nullif(F.regexp_extract(as_column(c), pattern, 1), F.lit("")).try_cast(kind)


def _text(c: ColumnLike, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(as_column(c), pattern, 1), F.lit(""))


def parse_took(c: ColumnLike) -> Column:
    """Seconds stated as "took N seconds"; NULL otherwise, the row stays."""
    return _number(c, STRICT_DURATION, "double")


def parse_duration(c: ColumnLike) -> Column:
    """Seconds stated in any of the known phrases."""
    return _number(c, ANY_DURATION, "double")


def deadlock_tables(c: ColumnLike) -> Column:
    """Distinct table names a deadlock message mentions, in order of appearance."""
    return F.array_distinct(F.regexp_extract_all(as_column(c), F.lit(LOCKED_TABLE), F.lit(1)))


def missing_database(c: ColumnLike) -> Column:
    return _text(c, MISSING_DATABASE)


def login_user(c: ColumnLike) -> Column:
    return _text(c, FAILED_LOGIN)


def advice(c: ColumnLike) -> Column:
    """Sentences that start with "Consider" or end with "recommended"."""
    sentences = F.transform(F.split(as_column(c), r"\."), lambda s: F.trim(s))
    return F.filter(sentences, lambda s: s.ilike("consider %") | s.ilike("% recommended"))


def message_facts(c: ColumnLike) -> Column:
    """Counts and identifiers a message states, as one struct."""
    return F.struct(
        _number(c, r"(\d+) rows scanned", "bigint").alias("rows_scanned"),
        _number(c, r"(\d+) index seek", "bigint").alias("index_seeks"),
        _text(c, r"Query hash: (0x[0-9A-Fa-f]+)").alias("query_hash"),
        _number(c, r"Process (\d+)", "bigint").alias("process_id"),
        _number(c, r"actual rows: (\d+) vs", "bigint").alias("estimated_rows"),
        _number(c, r"actual rows: \d+ vs (\d+)", "bigint").alias("actual_rows"),
    )
