"""Hourly roll-ups: late rows, redelivered and unfinished batches, ragged ranges, values no fixed point holds."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerlog.functions.stats import exact_avg
from ledgerlog.functions.timewin import bin_start
from ledgerlog.operators import rollup

KEYS = ["kind"]
SCHEMA = "t timestamp_ntz, kind string, v double, who int"


def rows(spark, n=4000, seed=3):
    r = random.Random(seed)
    start = dt.datetime(2024, 3, 1)
    odd = [None, math.nan, math.inf, 1e25, 1e-12, 0.0, -3.3]
    data = [(start + dt.timedelta(seconds=r.randrange(72 * 3600)), r.choice(["a", "a", "a", "b", None]),
             r.choice(odd) if r.random() < 0.01 else round(r.uniform(-5, 100), 3), r.randrange(300)) for _ in range(n)]
    return spark.createDataFrame(data + [(None, "a", 1.0, 1)], SCHEMA)


def shown(found):
    """Rows as text. Plain sums, which odd values lead to, depend on the order of the rows in their last digits."""
    return {(*(str(x) for x in r[:-3]), f"{r[-3]:.12g}" if r[-3] is not None else None, str(r[-2]), str(r[-1])) for r in found}


def direct(df, keys):
    return shown(df.groupBy(*keys).agg(
        F.count("*"), exact_avg("v"), F.min("v"), F.max("v")).collect())


def asked(parts, keys):
    return shown(rollup.summary(parts, keys).collect())


@pytest.fixture(scope="module")
def fed(spark, tmp_path_factory):
    """Batches dealt at random, so that nearly every row is late; two merged, one delivered twice, one unfinished."""
    folder, df = str(tmp_path_factory.mktemp("rollup")), rows(spark).cache()
    schema = rollup.states(df, "t", KEYS, "v").schema
    parts = [df.where(F.pmod(F.hash("t", "v", "who"), F.lit(4)) == i) for i in range(4)]
    before = rollup.stored(spark, folder, schema).count()
    for i in (0, 1, 2, 3, 3, 1):
        rollup.store(rollup.states(parts[i], "t", KEYS, "v"), folder, i, i)
        if i == 1:
            rollup.compact(spark, folder, schema, KEYS)
    unfinished = rollup.states(parts[0], "t", KEYS, "v").withColumn("hour_date", F.to_date("hour"))
    unfinished.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy(
        "hour_date").parquet(f"{folder}/first=4/last=4")
    assert before == 0
    return df, rollup.stored(spark, folder, schema), folder, schema


def test_batches_are_each_read_once(spark, fed):
    df, stored, folder, _ = fed
    assert rollup._finished(spark, folder) in ([(0, 1), (2, 2), (3, 3)], [(0, 3)])
    timed = df.where("t IS NOT NULL").withColumn("hour", bin_start("t", "1 hour"))
    assert asked(stored, ["hour", "kind"]) == direct(timed, ["hour", "kind"])
    assert asked(stored, ["kind"]) == direct(timed, ["kind"])


@pytest.mark.parametrize("start, end", [
    ("2024-03-01 05:20:00", "2024-03-02 17:40:00"), ("2024-03-01 05:00:00", "2024-03-02 17:00:00"),
    ("2024-03-01 05:20:00", "2024-03-01 05:50:00"), ("2024-03-01 05:20:00", "2024-03-01 06:10:00"),
    ("2020-01-01 00:00:00", "2020-01-02 00:00:00")])
def test_ranges_are_whole_hours_and_raw_ends(fed, start, end):
    df, stored, _, _ = fed
    inside = df.where(f"t BETWEEN timestamp_ntz'{start}' AND timestamp_ntz'{end}'").withColumn("hour", bin_start("t", "1 hour"))
    parts = rollup.in_range(stored, df, "t", KEYS, "v", start, end)
    assert asked(parts, ["hour", "kind"]) == direct(inside, ["hour", "kind"])


def test_whole_days_are_pruned(fed):
    df, stored, _, _ = fed
    parts = rollup.in_range(stored, df, "t", KEYS, "v", "2024-03-02 00:00:00", "2024-03-02 09:30:00")
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour_date" in plan and "2024-03-02" in plan


def test_overflowing_sums_take_the_plain_one(spark):
    big = spark.createDataFrame([(dt.datetime(2024, 3, 1), "a", 9e17, 1)] * 4, SCHEMA)
    wide = big.withColumn("v", F.col("v").cast("decimal(28,10)"))
    assert asked(rollup.states(wide, "t", KEYS, "v"), KEYS) == direct(wide, KEYS)


def test_distinct_sketches_merge(spark):
    df = spark.range(60_000).select(
        F.expr("timestamp_ntz'2024-03-01 00:00:00' + make_dt_interval(0, id % 48)").alias("t"),
        F.lit("a").alias("kind"), F.lit(1.0).alias("v"), F.expr("cast(id % 20000 as int)").alias("who"))
    parts = rollup.states(df, "t", KEYS, "v", ["who"])
    found = rollup.summary(parts, KEYS, ["who"]).first()
    assert found.n == 60_000 and abs(found.distinct_who - 20_000) <= 0.05 * 20_000
