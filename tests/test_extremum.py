"""First rows of groups by packed numbers: order of every type, ties, NULL, and plans without a sort below the shuffle."""

import datetime as dt
import math
import random
import struct

import pytest
from conftest import SMALL, plan
from pyspark.sql import functions as F

from ledgerlog.catalog import QUERIES
from ledgerlog.operators import extremum as ex
from ledgerlog.operators import joins as jn

DOUBLES = [None, -math.inf, -1.7976931348623157e308, -1e300, -2.0, -1.0000000000000002, -1.0, -0.1, -2.2250738585072014e-308,
           -2.225073858507201e-308, -5e-324, 0.0, 5e-324, 1e-310, 2.225073858507201e-308, 2.2250738585072014e-308, 1e-300, 0.1,
           0.9999999999999999, 1.0, 1.0000000000000002, 3.0, 4.0, 4.000000000000001, 7.999999999999999, 8.0, 2.0**52, 2.0**53, 1e16,
           1.7976931348623157e308, math.inf, math.nan]


def test_rank_of_doubles_is_their_bit_pattern(spark):
    rng = random.Random(1)
    values = [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)] + [2.0**k for k in range(-1074, 1024)]
    values = [v for v in values if not math.isnan(v)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", ex.double_rank(F.col("v")).alias("r"))
    for r in rows.collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(r.v)))[0]
        assert r.r == (-bits if r.v < 0 else bits), r.v


def test_doubles_keep_their_order(spark):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(DOUBLES)], "i int, v double")
    got = [r.i for r in rows.orderBy(ex.packed(rows, ["v"])[0]).collect()]
    assert got == list(range(len(DOUBLES)))
    zeros = spark.createDataFrame([(0.0,), (-0.0,)], "v double")
    assert zeros.select(ex.packed(zeros, ["v"])[0].alias("k")).distinct().count() == 1


KINDS = {
    "boolean": [None, False, True],
    "tinyint": [None, -128, 0, 127],
    "bigint": [None, -2**63, -1, 0, 5, 2**63 - 1],
    "date": [None, dt.date(1, 1, 1), dt.date(1970, 1, 1), dt.date(9999, 12, 31)],
    "timestamp_ntz": [None, dt.datetime(1, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), dt.datetime(1970, 1, 1),
                      dt.datetime(2024, 3, 31, 2, 30, 0, 1), dt.datetime(9999, 12, 31, 23, 59, 59, 999999)],
    "decimal(12,2)": [None, -9999999999.99, -0.01, 0, 0.01, 9999999999.99],
}


@pytest.mark.parametrize("kind", list(KINDS))
def test_every_type_keeps_its_order_beside_a_double(spark, kind):
    """All pairs of a value and a double, packed into one decimal or more, sort like the pair."""
    rows = spark.createDataFrame([(i, str(v) if v is not None else None) for i, v in enumerate(KINDS[kind])], "i int, t string")
    rows = rows.withColumn("a", F.col("t").cast(kind)).crossJoin(
        spark.createDataFrame([(j, v) for j, v in enumerate(DOUBLES)], "j int, b double"))
    got = [(r.i, r.j) for r in rows.repartition(3).orderBy(*ex.packed(rows, ["a", "b"])).select("i", "j").collect()]
    assert got == [(i, j) for i in range(len(KINDS[kind])) for j in range(len(DOUBLES))]


def _rows(spark, n=600):
    rng = random.Random(7)
    pick = lambda *v: rng.choice([None, *v])
    rows = [(pick(1, 2, 3, 4) if i % 3 else 1, pick(1.5, 2.5, -1.0), pick(2**62, -2**62), pick(7, 8), pick("x", "y", "")) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k int, a double, b bigint, c int, s string").repartition(4)


def _least(rows, key, last=False):
    none_first = lambda v: tuple((x is not None, x) if x is not None else (False, 0) for x in v)
    best = {}
    for r in rows:
        if r[0] not in best or ((key(r) != key(best[r[0]])) and (none_first(key(r)) < none_first(key(best[r[0]]))) != last):
            best[r[0]] = r
    return best


@pytest.mark.parametrize("last", [False, True])
def test_ties_over_several_decimals(spark, last):
    """Three wide columns need two decimals; a third of all rows is one group; most rows tie in the first columns."""
    rows, df = _rows(spark)
    assert len(ex.packed(df, ["a", "b", "c"])) == 2
    want = {k: r[1:4] for k, r in _least(rows, lambda r: r[1:4], last).items()}
    got = {r.k: (r.a, r.b, r.c) for r in ex.first_of(df, ["k"], ["a", "b", "c"], ["a", "b", "c"], last).collect()}
    assert got == want


def test_rows_with_text_are_fetched(spark):
    rows, df = _rows(spark)
    got = ex.first_whole(df, ["k"], ["a", "b", "c"]).collect()
    want = _least(rows, lambda r: r[1:4])
    assert {r.k: (r.a, r.b, r.c) for r in got} == {k: r[1:4] for k, r in want.items()} and len(got) == len(want)
    assert all(tuple(r) in rows for r in got)
    again = ex.first_whole(df.repartition(7), ["k"], ["a", "b", "c"]).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    text = ex.first_of(df, ["k"], ["s"], ["s"])
    assert {r.k: r.s for r in text.collect()} == {k: r[4] for k, r in _least(rows, lambda r: r[4:]).items()}


def test_pick_one_with_text(spark):
    rows, df = _rows(spark)
    base = spark.createDataFrame([(1,), (2,), (9,)], "k int")
    got = {r.k: (r.a, r.b, r.c) for r in jn.pick_one(base, df, "k", ["a", F.col("b"), "c"]).collect()}
    want = _least(rows, lambda r: r[1:4])
    assert got == {k: want[k][1:4] for k in (1, 2)}
    assert jn.pick_one(base, df.where("false"), "k", ["a"]).columns == ["k", "a", "b", "c", "s"]


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("str", "snk", "snp05"))])
def test_no_query_sorts_in_front_of_an_aggregation(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortAggregate" not in plan(QUERIES[name](spark, SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
