from conftest import DEADLOCKS, NOW, SLOW
from pyspark.sql import functions as F

from ledgerlog.functions import messages as m
from ledgerlog.plans import insights as q
from ledgerlog.plans import logs as p


def texts(spark, rows):
    return spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string").orderBy("i")


def column(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_durations(spark):
    df = texts(spark, SLOW)
    assert column(df, m.parse_took("t")) == [28.4, None, None, None, 22.8]
    assert column(df, m.parse_duration("t")) == [28.4, 15.7, 12.1, 9.3, 22.8]
    assert column(texts(spark, DEADLOCKS), m.parse_duration("t")) == [12.3, None, 8.7]


def test_deadlock_tables(spark):
    rows = DEADLOCKS + ["Transaction on DeadlockTableA was chosen as deadlock victim.", "nothing"]
    got = column(texts(spark, rows), m.deadlock_tables("t"))
    assert got == [["Policies", "Claims"], ["Customers"], ["Transactions"], ["DeadlockTableA"], []]


def test_facts(spark):
    facts = column(texts(spark, SLOW + DEADLOCKS), m.message_facts("t"))
    assert facts[0].rows_scanned == 360000 and facts[0].query_hash == "0x7A3F2B1C"
    assert facts[2].estimated_rows == 50 and facts[2].actual_rows == 12400
    assert facts[3].rows_scanned == 600 and facts[3].index_seeks == 0
    assert [f.process_id for f in facts[5:]] == [52, 67, 89]


def test_golden_counts(golden):
    got = {(r.EventID): r.Count for r in p.v01(golden, NOW, "30m").collect()}
    assert got == {911: 3, 208: 2, 17063: 17, 18456: 5, 3041: 1}
    assert {r.total for r in q.q01(golden, NOW, "30m").collect()} == {28}


def test_contains_ignores_case(golden):
    assert p.l10(golden, NOW).count() == 5
    assert golden.filter(F.col("RenderedDescription").contains("DEADLOCK")).count() == 4
    assert p.v03(golden, NOW).count() == 5
    assert p.l13(golden, NOW).count() == 10


def test_slowest(golden):
    assert [r.Duration for r in p.l11(golden, NOW).collect()] == [28.4, 22.8, None, None, None]
    assert [r.seconds for r in q.q11(golden, NOW).collect()] == [28.4, 22.8, 15.7, 12.1, 9.3]


def test_insights(golden):
    assert {r.database_name for r in q.q02(golden.filter("EventID = 911"), NOW).collect()} == {
        "NonExistentDB", "ClaimsDB", "ReportingDB"}
    assert {r.database_name: r.Count for r in q.q02(golden, NOW).collect()}["NonExistentDB"] == 2
    assert {r.login_user for r in q.q03(golden, NOW).collect()} == {"hacker", "dbadmin", "claimsapp", "root", "admin"}
    assert q.q04(golden, NOW).count() == 7
    assert q.q05(golden, NOW).count() == 1
    assert [r.attempts for r in q.q06(golden, NOW, "1 hour", 5).collect()] == [5]
    assert q.q08(golden, NOW).count() == 1
    named = {r.table_name for r in q.q12(golden, NOW).collect()}
    assert {"Policies", "Claims", "Customers", "Transactions", "PolicyHolders"} == named
    advice = {r.recommendation for r in q.q13(golden, NOW).collect()}
    assert {"Plan guide recommended", "Consider full-text index", "Retry recommended"} <= advice
    assert q.q14(golden, NOW).count() == 1
    by_category = {r.category: r.Count for r in q.q15(golden, NOW).collect()}
    assert by_category["deadlock"] == 5 and by_category["slow query"] == 5 and by_category["failed login"] == 6
    assert sum(by_category.values()) == 28
    assert q.q07(golden, NOW).first().category == "deadlock"


def test_newest_rows(golden):
    assert p.v12(golden, NOW).first().found == 4  # the fifth is exactly five minutes old: excluded
    assert [(r.EventLevelName, r.Count) for r in p.v11_levels(golden, NOW).collect()] == [("Error", 28)]
    previews = p.v11_previews(golden, NOW).collect()
    assert len(previews) == 5 and all(len(r.Preview) <= 153 and r.Preview.endswith("...") for r in previews)
