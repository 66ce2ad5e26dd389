"""Time-window predicates.

Bounds are computed once in Python and enter the plan as literals, so the column
itself stays bare and the comparison reaches the Parquet scan. Literals are
TIMESTAMP_NTZ: against an NTZ column nothing is cast, against a TIMESTAMP column
only the literal is.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

When = dt.datetime | dt.date | str
ColumnLike = Column | str

_SPAN = re.compile(r"^\s*(\d+)\s*(us|s|sec|second|m|min|minute|h|hour|d|day)s?\s*$")
_UNIT = {
    "us": "microseconds", "s": "seconds", "sec": "seconds", "second": "seconds",
    "m": "minutes", "min": "minutes", "minute": "minutes",
    "h": "hours", "hour": "hours", "d": "days", "day": "days",
}


def as_column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def moment(when: When) -> dt.datetime:
    """A naive UTC datetime out of a datetime, a date or ISO text."""
    if isinstance(when, str):
        when = dt.datetime.fromisoformat(when)
    if not isinstance(when, dt.datetime):
        return dt.datetime(when.year, when.month, when.day)
    if when.tzinfo is not None:
        when = when.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return when


def span(text: str | dt.timedelta) -> dt.timedelta:
    """``6h``, ``24 hours``, ``2d``, ``30 minutes`` as a timedelta."""
    if isinstance(text, dt.timedelta):
        return text
    match = _SPAN.match(text)
    if not match:
        raise ValueError(f"not a time span: {text!r}")
    return dt.timedelta(**{_UNIT[match.group(2)]: int(match.group(1))})


def ts_lit(when: When) -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{moment(when).isoformat(sep=' ')}'")


def date_lit(when: When) -> Column:
    return F.lit(moment(when).date())


@dataclass(frozen=True)
class Span:
    """A stretch of time with computed bounds; either may be missing."""

    start: dt.datetime | None = None
    end: dt.datetime | None = None
    after_start: bool = False
    before_end: bool = False

    def on(self, ts: ColumnLike) -> Column:
        """The predicate on a timestamp column."""
        ts = as_column(ts)
        parts = []
        if self.start is not None:
            parts.append(ts > ts_lit(self.start) if self.after_start else ts >= ts_lit(self.start))
        if self.end is not None:
            parts.append(ts < ts_lit(self.end) if self.before_end else ts <= ts_lit(self.end))
        return reduce(lambda x, y: x & y, parts, F.lit(True)) if len(parts) != 1 else parts[0]

    def on_days(self, day: ColumnLike) -> Column:
        """The wider predicate on a date column, for folders that hold one day each."""
        day = as_column(day)
        first = day >= F.lit(self.start.date()) if self.start is not None else F.lit(True)
        return first & (day <= F.lit(self.end.date())) if self.end is not None else first


def between_span(start: When, end: When, closed: str = "both") -> Span:
    if closed not in ("both", "left"):
        raise ValueError("closed must be 'both' or 'left'")
    return Span(moment(start), moment(end), before_end=closed == "left")


def since_span(as_of: When, ago: str | dt.timedelta) -> Span:
    return Span(moment(as_of) - span(ago), moment(as_of), after_start=True)


def recent_span(as_of: When, ago: str | dt.timedelta = "24h", days: int = 30) -> Span:
    """The last ``ago`` before ``as_of``, but no more than ``days``."""
    return since_span(as_of, min(span(ago), dt.timedelta(days=days)))


def start_of_day(as_of: When) -> dt.datetime:
    return moment(moment(as_of).date())


def start_of_week(as_of: When) -> dt.datetime:
    """Midnight of the Sunday on or before ``as_of``."""
    day = start_of_day(as_of)
    return day - dt.timedelta(days=(day.weekday() + 1) % 7)


def today_span(as_of: When) -> Span:
    return Span(start_of_day(as_of), moment(as_of), after_start=True)


def week_span(as_of: When) -> Span:
    return Span(start_of_week(as_of), moment(as_of), after_start=True)


def yesterday_span(as_of: When) -> Span:
    now = moment(as_of)
    return Span(now - dt.timedelta(days=2), now - dt.timedelta(days=1))


def hour_span(at: When, around: bool = False) -> Span:
    at = moment(at)
    hour = dt.timedelta(hours=1)
    return Span(at - hour if around else at, at + hour)


def clamp_span(as_of: When, days: int = 30) -> Span:
    now = moment(as_of)
    return Span(now - dt.timedelta(days=days), now)


def time_between(ts: ColumnLike, start: When, end: When, closed: str = "both") -> Column:
    return between_span(start, end, closed).on(ts)


def since(ts: ColumnLike, as_of: When, ago: str | dt.timedelta) -> Column:
    """Strictly later than ``as_of - ago``, and not after ``as_of`` itself."""
    return since_span(as_of, ago).on(ts)


def today(ts: ColumnLike, as_of: When) -> Column:
    """Strictly after midnight, and not after ``as_of`` itself."""
    return today_span(as_of).on(ts)


def this_week(ts: ColumnLike, as_of: When) -> Column:
    """Strictly after the last Sunday midnight, and not after ``as_of`` itself."""
    return week_span(as_of).on(ts)


def rolling_yesterday(ts: ColumnLike, as_of: When) -> Column:
    """The 24 hours that ended 24 hours before ``as_of``, both ends included."""
    return yesterday_span(as_of).on(ts)


def hour_window(ts: ColumnLike, at: When, around: bool = False) -> Column:
    """One hour from ``at``; "around" widens it to one hour on either side."""
    return hour_span(at, around).on(ts)


def clamp(ts: ColumnLike, as_of: When, days: int = 30) -> Column:
    """Outer safety bound that is ANDed with whatever filter a query has."""
    return clamp_span(as_of, days).on(ts)


def during(df: DataFrame, ts: str, window: Span, day: str = "event_date") -> DataFrame:
    """Rows of a time span. A table kept in day folders is pruned by folder as well."""
    if day in df.columns:
        df = df.filter(window.on_days(day))
    return df.filter(window.on(ts))


def date_window(day: ColumnLike, as_of: When, days: int) -> Column:
    """Dates whose midnight lies in [as_of, as_of + days].

    A time of day in ``as_of`` excludes that same day, as a datetime comparison would.
    """
    now = moment(as_of)
    first = now.date() if now == start_of_day(now) else now.date() + dt.timedelta(days=1)
    last = now.date() + dt.timedelta(days=days)
    return as_column(day).between(F.lit(first), F.lit(last))


def years_before(as_of: When, years: int = 1) -> dt.datetime:
    """Same moment ``years`` earlier; 29 February falls back to the 28th."""
    now = moment(as_of)
    try:
        return now.replace(year=now.year - years)
    except ValueError:
        return now.replace(year=now.year - years, day=28)


def bin_start(ts: ColumnLike, width: str = "1 hour") -> Column:
    """Start of the epoch-aligned bin; the column keeps its timestamp type."""
    return F.window(as_column(ts), width)["start"]
