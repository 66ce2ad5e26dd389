"""Fixtures of the corpus tests."""

import pytest

from ledgerlog.llm.shared import shipped


@pytest.fixture(scope="session", autouse=True)
def importable(spark):
    shipped(spark)


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def middle():
    return "/root/testdata/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
