"""Every named query against its SQL on the smallest sample."""

import os
import sys

import duckdb
import pytest
from conftest import SMALL

from ledgerlog.catalog import ORACLES, QUERIES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import TABLES, rows  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    found = con.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, map(tuple, df.collect())) == rows(names, found.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
