"""The corpus queries against their SQL on the smallest sample."""

import duckdb
import pytest
from llm_common import importable, small  # noqa: F401

from ledgerlog.llm.queries import ORACLES, QUERIES

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    found = con.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    df = QUERIES[name](spark, small)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(repr, map(tuple, df.select(names).collect()))) == sorted(map(repr, found.fetchall()))
