"""What the physical plans must and must not contain."""

import re

import pytest
from conftest import SMALL, plan
from pyspark.sql import functions as F

from ledgerlog.catalog import ORACLES, QUERIES
from ledgerlog.functions import timewin as tw
from ledgerlog.operators import topk as tk
from ledgerlog.plans import logs, reports
from ledgerlog.schemas import EVENT, conform
from ledgerlog.session import fresh_path
from ledgerlog.catalog.bindings import CODES, Sample

BATCH = [n for n in QUERIES if not n.startswith(("str", "snk", "snp05"))]


@pytest.fixture(scope="module")
def event_table(spark):
    path = fresh_path(spark, "events")
    conform(Sample(spark, SMALL).log, EVENT).write.parquet(path)
    return spark.read.schema(EVENT).parquet(path)


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)


def test_time_and_level_reach_the_scan(event_table):
    text = plan(logs.l01(event_table, "2024-01-30", "2024-01-31"))
    pushed = re.search(r"PushedFilters: \[([^\]]*)", text).group(1)
    assert "GreaterThanOrEqual(TimeGenerated" in pushed and "LessThanOrEqual(TimeGenerated" in pushed
    assert "EqualTo(EventLevelName" in pushed
    assert "Computer" not in re.search(r"ReadSchema: (\S+)", text).group(1)


def test_ntz_and_utc_columns_are_compared_bare(spark):
    stored = spark.read.parquet(f"{SMALL}/events.parquet")
    assert "GreaterThan(ts" in plan(stored.filter(tw.since("ts", "2024-01-31", "1d")))


def test_day_folders_are_pruned(spark):
    from ledgerlog.sources.writers import drop_expired, write_log

    path = fresh_path(spark, "log")
    write_log(Sample(spark, SMALL).log, path)
    text = plan(drop_expired(spark.read.parquet(path), "2024-01-31", 2))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", text)


def test_log_questions_prune_day_folders(spark):
    from ledgerlog.sources.writers import write_log

    path = fresh_path(spark, "log")
    write_log(Sample(spark, SMALL).log, path)
    rows = logs.l09(spark.read.parquet(path), "2024-01-31")
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", plan(rows))
    assert rows.count() == logs.l09(Sample(spark, SMALL).log, "2024-01-31").count() > 0


def test_limits_are_taken_per_task(event_table):
    assert "TakeOrderedAndProject" in plan(logs.l11(event_table, "2024-01-31"))
    grouped = tk.first_per_group(event_table.select("Source", "TimeGenerated"), ["Source"], ["TimeGenerated"], 3)
    text = plan(grouped)
    below = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below


def test_detail_is_aggregated_before_its_outer_join(spark):
    tables = Sample(spark, SMALL).lean_business
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(reports.b07(tables))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    outer = text[text.index("LeftOuter"):]
    assert outer.index("HashAggregate") < outer.index("FileScan", outer.index("FileScan") + 1)


def test_heavy_top_k_limits_first(spark):
    from ledgerlog.plans.heavy import p02

    text = plan(p02(Sample(spark, SMALL).lean_business, 5))
    assert text.count("LeftSemi, BuildRight") == 2 and "TakeOrderedAndProject" in text


def test_results_do_not_depend_on_partitioning(spark):
    tables = dict(Sample(spark, SMALL).business)
    want = sorted(map(tuple, reports.b05(tables, CODES).collect()))
    shuffled = {k: v.repartition(7, F.rand(1)) for k, v in tables.items()}
    assert sorted(map(tuple, reports.b05(shuffled, CODES).collect())) == want


WIDE = {"email", "phone", "package_name", "claim_number", "description", "annual_premium", "claim_category"}


def _moved(node):
    """Names of the columns of each exchange that is no broadcast."""
    if node.nodeName() == "Exchange":
        yield set(node.output().mkString(",").replace("#", ",").split(","))
    for i in range(node.children().size()):
        yield from _moved(node.children().apply(i))


@pytest.mark.parametrize("name", ["b01", "b03", "b11", "b16", "b20"])
def test_top_k_reports_move_no_wide_columns(spark, name):
    """Neither before the limit nor when the first k are fetched; names in the sort order excepted."""
    tables = Sample(spark, SMALL).business
    more = {"b01": (CODES,), "b03": ("2024-01-31", CODES), "b11": (CODES,)}.get(name, ())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        moved = list(_moved(getattr(reports, name)(tables, *more)._jdf.queryExecution().executedPlan()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    wide = WIDE - ({"annual_premium"} if name == "b11" else set())
    assert moved and not any(columns & wide for columns in moved)


def test_constraint_checks_are_one_aggregation(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["dq01_constraint_checks"](spark, SMALL))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # seven tables, of which the sample makes two from two others
    assert len(re.findall(r"\bExchange\b", text)) < 12 and text.count("FileScan") == 9
