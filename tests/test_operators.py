"""Operators on random rows with one hot key, against brute force."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlog.functions import stats as st
from ledgerlog.functions import text as tx
from ledgerlog.operators import aggregates as ag
from ledgerlog.operators import joins as jn
from ledgerlog.operators import topk as tk
from ledgerlog.operators import windows as wn
from ledgerlog.session import fresh_path


@pytest.fixture(scope="module")
def pairs():
    rnd = random.Random(7)
    # key 0 holds a third of all rows
    return [(0 if rnd.random() < 1 / 3 else rnd.randrange(1, 40), rnd.randrange(1, 1000), i) for i in range(3000)]


@pytest.fixture(scope="module")
def df(spark, pairs):
    return spark.createDataFrame(pairs, "k int, v int, pos int").repartition(6)


def groups(pairs):
    out = defaultdict(list)
    for k, v, pos in pairs:
        out[k].append((v, pos))
    return out


def test_above_own_mean(df, pairs):
    want = {k for k, vs in groups(pairs).items() if max(v for v, _ in vs) > 2 * sum(v for v, _ in vs) / len(vs)}
    got = jn.groups_above_own_mean(df.withColumn("one", F.lit(1)), "k", "v", "v", "one")
    assert {r.k for r in got.collect()} == want


def test_above_global_mean(df, pairs):
    mean = sum(v for _, v, _ in pairs) / len(pairs)
    got = jn.above_global_mean(df, "v", 1.5)
    assert got.count() == sum(v > 1.5 * mean for _, v, _ in pairs)


def test_cross_count(df):
    small = df.filter("v < 100")
    got = jn.cross_count([df, small]).first().pair_count
    assert int(got) == df.crossJoin(small).count()


def test_attach_pick_update(spark, df, pairs):
    by = groups(pairs)
    base = spark.range(0, 45).select(F.col("id").cast("int").alias("k"))
    got = {r.k: (r.n, r.top) for r in jn.attach_aggs(
        base, df, "k", [F.count("*").alias("n"), F.max("v").alias("top")], ["n"]).collect()}
    assert got == {k: (len(by.get(k, [])), max((v for v, _ in by.get(k, [])), default=None)) for k in range(45)}
    picked = {r.k: (r.v, r.pos) for r in jn.pick_one(base, df, "k", ["v", "pos"]).collect()}
    assert picked == {k: min(vs) for k, vs in by.items()}
    updates = spark.createDataFrame([(1, 10), (2, None)], "k int, n int")
    changed = jn.update_from(base.withColumn("x", F.lit(5)), updates, "k", {"x": "n"})
    assert {r.k: r.x for r in changed.filter("k < 4").collect()} == {0: 5, 1: 10, 2: None, 3: 5}


def test_single_keys(spark):
    d = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k int")
    assert sorted(r.k for r in jn.keys_with_count(d, "k").collect()) == [1, 3]


def test_distinct_list_and_first_seen(df, pairs):
    by = groups(pairs)
    got = {r.k: r.names for r in ag.distinct_list(df.withColumn("s", (F.col("v") % 5).cast("string")), ["k"], "s",
                                                   "names").collect()}
    assert got == {k: ", ".join(sorted({str(v % 5) for v, _ in vs})) for k, vs in by.items()}
    seen = {(r.k, r.w): r.first_pos.pos for r in ag.first_seen(
        df.withColumn("w", F.col("v") % 3), ["k", "w"], ["pos"]).collect()}
    want = {}
    for k, v, pos in pairs:
        want.setdefault((k, v % 3), pos)
    assert seen == want


def test_first_per_group_and_union(df, pairs):
    by = groups(pairs)
    got = defaultdict(list)
    for r in tk.first_per_group(df, ["k"], ["pos"], 3).collect():
        got[r.k].append(r.pos)
    assert {k: sorted(v) for k, v in got.items()} == {k: [p for _, p in vs][:3] for k, vs in by.items()}
    a, b = df.filter("pos < 1500").withColumn("w", F.col("v") % 9), df.filter("pos >= 1500").withColumn("w", F.col("v") % 9)
    out = defaultdict(list)
    for r in sorted(tk.union_first_seen(a.select("k", "w", "pos"), b.select("k", "w", "pos"), "k", "w", "pos", 4)
                    .collect(), key=lambda r: (r.side, r.pos)):
        out[r.k].append(r.w)
    want = {k: list(dict.fromkeys(v % 9 for v, _ in vs))[:4] for k, vs in by.items()}
    assert dict(out) == want


@pytest.mark.parametrize("slices", [1, 3, 16])
def test_dense_ids(spark, slices):
    keys = random.Random(3).sample(range(10**6), 500)
    d = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = {r.k: r.n for r in wn.dense_ids(d, "k", "n", fresh_path(spark, "n"), 11, slices).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys), 11)}


def test_dense_ids_of_nothing(spark):
    assert wn.dense_ids(spark.range(0), "id", "n", fresh_path(spark, "n")).count() == 0


def test_samples_repeat(df):
    once = tk.sample_k(df.select("pos"), "pos", 10, "s").collect()
    assert once == tk.sample_k(df.select("pos").repartition(3), "pos", 10, "s").collect()
    assert once != tk.sample_k(df.select("pos"), "pos", 10, "t").collect()


def test_stats(spark):
    d = spark.createDataFrame([(1, None), (2, 10), (-5, 0)], "a int, b int")
    r = d.agg(st.int_avg("a").alias("i"), st.exact_avg("b").alias("e"), st.sum0("b").alias("z"),
              st.sum_where(F.col("a") > 0).alias("w")).first()
    assert (r.i, r.e, r.z, r.w) == (0, 5.0, 10, 2)
    got = [x[0] for x in d.orderBy("a").select(st.safe_pct(F.col("a"), F.col("b"))).collect()]
    assert got[0] is None and got[1] is None and float(got[2]) == 20.0
    assert spark.range(1).select(st.safe_pct(F.lit(10**6), F.lit(1))).first()[0] is None


def test_text(spark):
    d = spark.createDataFrame([(0,), (1,), (3,), (4,), (None,)], "i int")
    assert [r[0] for r in d.select(tx.choose("i", "a", "b", "c")).collect()] == [None, "a", "c", None, None]
    assert [r[0] for r in d.filter("i > 0").select(tx.zero_pad(F.col("i") * 1111, 3)).collect()] == ["111", "333", "444"]
    s = spark.createDataFrame([("100% sure_thing",), ("100 SURE",)], "t string")
    assert s.filter(tx.contains_ci("t", "% SURE_")).count() == 1
    assert s.filter(tx.any_like("t", ["%sure%"])).count() == 2


def test_mean_of_odd_values(spark):
    from ledgerlog.functions.stats import exact_avg

    groups = {"nan": [float("nan"), 1.0], "inf": [float("inf"), 1.0], "large": [1e19, 1.0], "tiny": [1e-12, 3e-12],
              "none": [None, None], "plain": [0.1, 0.2, None], "zero": [0.0, 1.0]}
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    got = dict(spark.createDataFrame(rows, "g string, v double").groupBy("g").agg(exact_avg("v")).collect())
    assert got.pop("nan") != got.get("nan") and got["inf"] == float("inf") and got["large"] == 5e18 + 0.5
    assert got["tiny"] == 2e-12 and got["none"] is None and abs(got["plain"] - 0.15) < 1e-15 and got["zero"] == 0.5


def test_references_stay_distinct(spark):
    from ledgerlog.operators.windows import number_rows

    got = [r.ref for r in number_rows(spark.range(1500), ["id"], F.lit("T"), "ref").collect()]
    assert len(set(got)) == 1500 and {"T001", "T999", "T1500"} <= set(got)


def test_first_of_many_per_group_is_limited_below_the_shuffle(spark):
    from conftest import plan
    from ledgerlog.operators.topk import first_per_group

    df = spark.range(20_000).selectExpr("id % 2 AS g", "id")
    got = first_per_group(df, ["g"], ["id"], 5000)
    assert "WindowGroupLimit" in plan(got) and got.count() == 10_000


def test_missing_column_of_a_check_is_an_error(spark):
    import pytest
    from ledgerlog.operators.quality import check_tables

    with pytest.raises(Exception):
        check_tables({"customers": spark.range(1)})
