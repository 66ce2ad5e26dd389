"""Shards by lookup table: against a plain refilling, even, steady, and on awkward rows."""

from collections import Counter

import numpy as np
import pytest
from llm_common import importable, small  # noqa: F401
from pyspark.sql import functions as F

from ledgerlog.llm import sharding
from ledgerlog.llm.queries import QUERIES
from ledgerlog.llm.shared import scratch

NAMES = [f"shard-{i:02d}" for i in range(16)]


def plain_table(names, slots):
    orders = []
    for name in names:
        offset, skip = sharding.preference(name, slots)
        orders.append([(offset + j * skip) % slots for j in range(slots)])
    table = {}
    while len(table) < slots:
        for i, order in enumerate(orders):
            if len(table) < slots:
                table[next(s for s in order if s not in table)] = i
    return [table[s] for s in range(slots)]


@pytest.mark.parametrize("n,slots", [(1, 7), (3, 31), (7, 211)])
def test_table_is_filled_in_turns(n, slots):
    assert sharding.lookup_table(NAMES[:n], slots).tolist() == plain_table(NAMES[:n], slots)


def test_even_and_steady():
    table = sharding.lookup_table(NAMES)
    sizes = np.bincount(table)
    assert sizes.max() - sizes.min() <= 1
    fewer = sharding.lookup_table(NAMES[:-1])
    stayed = table != 15
    assert (table[stayed] == fewer[stayed]).mean() > 0.9
    twice = np.bincount(sharding.lookup_table(NAMES[:3], turns={NAMES[0]: 2}))
    assert abs(twice[0] - 2 * twice[1]) <= 2


def test_bad_tables():
    for shards, slots in (([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            sharding.lookup_table(shards, slots)


def test_rows_keep_their_shard(spark):
    rows = [(1, "a", "old"), (1, "a", "old"), (None, None, None), (2, "", "x"), (3, "x" * 100_000, "y")]
    df = spark.createDataFrame(rows, "k bigint, t string, shard string")
    out = sharding.place(df, ["k"], NAMES, 211)
    assert out.columns == ["k", "t", "slot", "shard"]
    table = sharding.lookup_table(NAMES, 211)
    found = out.collect()
    assert len(found) == 5 and all(r.shard == NAMES[table[r.slot]] for r in found)
    assert len({r.shard for r in found if r.k == 1}) == 1
    assert sharding.place(df.where("false"), ["k"], NAMES, 211).collect() == []
    path = scratch(spark, "shards")
    sharding.write_shards(out, path)
    assert sorted(map(str, (r.k for r in spark.read.parquet(path).collect()))) == sorted(str(r[0]) for r in rows)


def test_a_hot_key_is_spread_by_a_second_key(spark):
    df = spark.range(4000).withColumn("source", F.lit("hot"))
    assert sharding.place(df, ["source"], NAMES).select("shard").distinct().count() == 1
    sizes = Counter(r.shard for r in sharding.place(df, ["source", "id"], NAMES).collect())
    assert len(sizes) == 16 and max(sizes.values()) < 400


def test_query_places_every_document(spark, small):
    out = QUERIES["op7_lookup_sharding"](spark, small)
    ids = spark.read.parquet(f"{small}/documents.parquet").select("doc_id")
    assert out.select("doc_id").exceptAll(ids).count() == 0 == ids.exceptAll(out.select("doc_id")).count()
