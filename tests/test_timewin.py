import datetime as dt

import pytest
from conftest import at

from ledgerlog.functions import timewin as tw


def kept(spark, times, cond):
    df = spark.createDataFrame([(at(t),) for t in times], "ts timestamp_ntz")
    return [str(r.ts) for r in df.filter(cond).orderBy("ts").collect()]


def test_since_is_strict(spark):
    times = ["2026-04-19 12:00:00", "2026-04-19 12:00:01", "2026-04-20 12:00:00", "2026-04-20 12:00:01"]
    assert kept(spark, times, tw.since("ts", "2026-04-20 12:00:00", "24h")) == times[1:3]


def test_recent_is_clamped():
    assert tw.recent_span("2026-04-20", "90d").start == at("2026-03-21 00:00:00")
    assert tw.recent_span("2026-04-20").start == at("2026-04-19 00:00:00")


def test_between_both_and_left(spark):
    times = ["2026-04-12 00:00:00", "2026-04-12 08:00:00", "2026-04-13 00:00:00"]
    assert kept(spark, times, tw.time_between("ts", "2026-04-12", "2026-04-13")) == times
    assert kept(spark, times, tw.time_between("ts", "2026-04-12", "2026-04-13", "left")) == times[:2]


def test_today_excludes_midnight(spark):
    times = ["2026-04-20 00:00:00", "2026-04-20 00:00:01", "2026-04-20 11:00:00"]
    assert kept(spark, times, tw.today("ts", "2026-04-20 12:00:00")) == times[1:]


@pytest.mark.parametrize("day,start", [
    ("2026-04-19", "2026-04-19"),  # a Sunday
    ("2026-04-20", "2026-04-19"),  # a Monday
    ("2026-04-25", "2026-04-19"),  # a Saturday
])
def test_week_starts_on_sunday(day, start):
    assert tw.start_of_week(f"{day} 15:30:00") == at(f"{start} 00:00:00")


def test_rolling_yesterday_is_not_a_calendar_day(spark):
    times = ["2026-04-18 11:59:59", "2026-04-18 12:00:00", "2026-04-19 12:00:00", "2026-04-19 12:00:01"]
    assert kept(spark, times, tw.rolling_yesterday("ts", "2026-04-20 12:00:00")) == times[1:3]


def test_hour_window_and_around(spark):
    times = ["2026-04-20 11:00:00", "2026-04-20 12:00:00", "2026-04-20 13:00:00", "2026-04-20 13:00:01"]
    assert kept(spark, times, tw.hour_window("ts", "2026-04-20 12:00:00")) == times[1:3]
    assert kept(spark, times, tw.hour_window("ts", "2026-04-20 12:00:00", around=True)) == times[:3]


def test_date_window_with_time_of_day(spark):
    days = [(dt.date(2026, 4, 20),), (dt.date(2026, 4, 21),), (dt.date(2026, 7, 19),), (dt.date(2026, 7, 20),)]
    df = spark.createDataFrame(days, "d date")
    midnight = df.filter(tw.date_window("d", "2026-04-20", 90)).count()
    noon = df.filter(tw.date_window("d", "2026-04-20 12:00:00", 90)).count()
    assert (midnight, noon) == (3, 2)


def test_spans_and_leap_day():
    assert tw.span("30m") == dt.timedelta(minutes=30)
    assert tw.span("2 days") == dt.timedelta(days=2)
    with pytest.raises(ValueError):
        tw.span("soon")
    assert tw.years_before("2024-02-29") == at("2023-02-28")
    assert tw.moment("2026-04-20T12:00:00+02:00") == at("2026-04-20 10:00:00")
