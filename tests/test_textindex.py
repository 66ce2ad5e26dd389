"""Search by an index of stretches: the same rows as a full scan, from fewer files."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlog.functions.text import any_col_like
from ledgerlog.session import fresh_path
from ledgerlog.sources import textindex as ti


@pytest.fixture(scope="module")
def words():
    rng = random.Random(2)
    return ["".join(rng.choices("abcdefghij", k=6)) for _ in range(400)]


@pytest.fixture(scope="module")
def stored(spark, words):
    """Sixteen files, each with words of its own; NULL, short, long and non-ASCII texts among them."""
    rng = random.Random(3)
    rows = []
    for part in range(16):
        own = words[part * 25:(part + 1) * 25]
        rows += [(part, i, " ".join(rng.choices(own, k=4)).upper() if i % 2 else " ".join(rng.choices(own, k=4)), rng.choice(own))
                 for i in range(40)]
    rows += [(0, 100, None, None), (1, 101, "", "ab"), (2, 102, "100% sure_thing", "x"), (3, 103, "Großes ÜBER été", "K"),
             (4, 104, "word " * 20_000, "y"), (5, 105, "\u212aelvin", "z")]
    path, index = fresh_path(spark, "texts"), fresh_path(spark, "index")
    spark.createDataFrame(rows, "part int, n int, a string, b string").repartition(16, "part").write.partitionBy("part").parquet(path)
    assert ti.index_files(spark, path, ["a", "b"], index) == 16
    assert ti.index_files(spark, path, ["a", "b"], index) == 0
    return path, index


def both(spark, stored, pairs):
    path, index = stored
    found = ti.search(spark, path, index, pairs)
    want = spark.read.parquet(path).where(any_col_like(pairs))
    assert found.schema == want.schema
    assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))
    return len(ti.candidate_files(spark, path, index, pairs)), found.count()


def test_files_read_fall(spark, stored, words):
    for i in (0, 60, 399):
        files, rows = both(spark, stored, [("a", f"%{words[i]}%")])
        assert files < 4 and rows
        files, rows = both(spark, stored, [("a", f"%{words[i].upper()}%{words[i]}"), ("b", words[0])])
        assert files < 6
    plan = ti.search(spark, *stored, [("a", f"%{words[60]}%")])
    assert len(plan.inputFiles()) < 4


@pytest.mark.parametrize("pairs", [
    [("a", "%100\\% sure\\_thing%")], [("a", "%über%")], [("a", "%GROSSES%")], [("a", "%große%")], [("a", "%kelvin%")],
    [("a", "%elvin%")], [("a", "%ab%")], [("b", "_")], [("a", "%")], [("a", "")], [("a", "%nowhere to be found%")],
    [("a", "%wor_ word%"), ("b", "k")], [("b", "%zzz%"), ("a", "%zzzz%")],
])
def test_same_rows_as_a_scan(spark, stored, pairs):
    both(spark, stored, pairs)


def test_nothing_found_opens_no_file(spark, stored):
    path, index = stored
    assert ti.candidate_files(spark, path, index, [("a", "%zzzz%")]) == []
    assert ti.search(spark, path, index, [("a", "%zzzz%")]).count() == 0


def test_appended_files_are_found_before_and_after_indexing(spark, words):
    path, index = fresh_path(spark, "texts"), fresh_path(spark, "index")
    pairs = [("a", f"%{words[5]}%")]
    spark.range(50).select(F.lit(words[1]).alias("a")).write.parquet(path)
    assert ti.search(spark, path, index, pairs).count() == 0 and len(ti.candidate_files(spark, path, index, pairs)) > 0
    ti.index_files(spark, path, ["a"], index)
    assert ti.candidate_files(spark, path, index, pairs) == []
    spark.range(7).select(F.lit(words[5]).alias("a")).coalesce(1).write.mode("append").parquet(path)
    assert ti.search(spark, path, index, pairs).count() == 7
    assert ti.index_files(spark, path, ["a"], index) == 1
    assert ti.search(spark, path, index, pairs).count() == 7 and len(ti.candidate_files(spark, path, index, pairs)) == 1
