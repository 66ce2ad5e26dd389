"""Text jobs against plain-Python restatements of their rules."""

import json

from conftest import at

from ledgerlog.operators import enrichment as e
from ledgerlog.plans.answers import documentation, search_terms


def one_column(spark, rows, expr):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t string")
    return [r[1] for r in sorted(df.select("i", expr).collect())]


LOG = [  # group, minute, level, source, id, text
    ("a", 1, "Error", "S1", 911, "Database X does not exist. More."),
    ("a", 2, "Information", "S1", 1, "Not looked at because of its level."),
    ("a", 3, "Warning", "S1", 911, "Database X does not exist. Again."),
    ("a", 4, "Error", "S2", 0, "Line one is long enough\nline two"),
    ("a", 5, "Error", "S2", 5, "short"),
    ("b", 1, "error", "S3", None, "Exactly twenty chars"),
    ("b", 2, "Error", "S3", 7, "This one is certainly longer than twenty"),
    ("c", 1, "Information", "S4", 9, "No term comes out of this group at all"),
]


def rows(spark):
    return spark.createDataFrame(
        LOG, "g string, m int, EventLevelName string, Source string, EventID int, RenderedDescription string")


def terms(df, cols=("m", "branch")):
    out = {}
    for r in sorted(df.collect(), key=lambda r: tuple(r[c] for c in cols)):
        out.setdefault(r.g, []).append(r.term)
    return out


def test_error_terms(spark):
    assert terms(e.error_terms(rows(spark), "g", ["m"])) == {
        "a": ["SQL Server S1 EventID 911", "SQL Server Database X does not exist",
              "SQL Server Line one is long enough"],
        "b": ["SQL Server S3 EventID 7", "SQL Server This one is certainly longer than twenty"],
    }
    assert terms(e.error_terms(rows(spark), "g", ["m"], k=4))["a"][3] == "SQL Server S2 EventID 5"


def test_fallback_ids(spark):
    got = one_column(spark, ["{'EventID': 7}, {'EventID': 7}, {'EventID': 8}", "{'EventID':  7} {'EventID': 9}", ""],
                     e.event_ids("t"))
    assert got == [["SQL Server EventID 7"], ["SQL Server EventID 7", "SQL Server EventID 9"], []]


def test_question_terms(spark):
    got = one_column(spark, ["  Any Deadlock or deadlock, Timeout? ", "What now?", "x" * 200], e.question_terms("t"))
    assert got[0] == ["SQL Server Any Deadlock or deadlock, Timeout?",
                      "SQL Server Deadlock deadlock Timeout troubleshoot"]
    assert got[1] == ["SQL Server What now?"]
    assert got[2] == ["SQL Server " + "x" * 150]


HOSTED = "https://learn.microsoft.com/en-us/sql/"
DOCS = [
    json.dumps([{"title": "A", "url": "u1", "description": "<b>x</b> y "}, {"title": "", "url": "u2"},
                {"title": "C", "link": "u3", "snippet": "s"}, {"title": "D", "url": "u4"}]),
    json.dumps({"results": [], "items": [{"title": "I", "url": "u", "summary": "z"}]}),
    json.dumps({"value": [{"title": "V", "url": "u"}]}),
    f"See [ One ]({HOSTED}one) and [Two]({HOSTED}two) and [no](https://other.example/x)",
    f"Visit {HOSTED}always-on-2022s/ or {HOSTED}x.",
    "A passage without a known host that is longer than fifty characters: http://other.example/p",
    "too short http://a.b/c",
    '{"results": [{"title": "cut off',
    json.dumps({"title": "top", "url": "level"}),
    f"[broken json {HOSTED}page",
]


def test_parse_docs(spark):
    got = [[tuple(d) for d in row] for row in one_column(spark, DOCS, e.parse_docs("t"))]
    assert got == [
        [("A", "u1", "x y"), ("C", "u3", "s")],
        [("I", "u", "z")],
        [("V", "u", "")],
        [("One", HOSTED + "one", ""), ("Two", HOSTED + "two", "")],
        [("Always On 2022S", HOSTED + "always-on-2022s/", ""), ("X.", HOSTED + "x.", "")],
        [("Microsoft Learn Documentation", "http://other.example/p", DOCS[5])],
        [], [], [],
        [("Page", HOSTED + "page", "")],
    ]


def test_strip_html_sse_and_blocks(spark):
    assert one_column(spark, [" <p>a <b>b</b></p> ", "1 < 2 and 3 > 2"], e.strip_html("t")) == ["a b", "1  2"]
    bodies = ['data: {"a": 1}\n\ndata: {"b": 2}\ndata: {bad', "event: x\n", '  data:{"c": 3}  \ndata:   ', ""]
    assert one_column(spark, bodies, e.last_sse("t")) == ['{"b": 2}', None, '{"c": 3}', None]
    replies = ["x\n```kql\nEvent\n| take 5\n```\n```kql\nPerf\n```", "no block", "```sql\nselect 1\n```"]
    assert one_column(spark, replies, e.fenced_block("t")) == ["Event\n| take 5", None, None]


QUESTIONS = {
    "Why did errors happen on 12 April 2026?": ("2026-04-12", "2026-04-13", "day", "both"),
    "Errors on 2026-04-12": ("2026-04-12", "2026-04-13", "day", "both"),
    "Tell me the latest log on 12:00pm 20 April 2026": ("2026-04-20 12:00", "2026-04-20 13:00", "hour", "both"),
    "logs around 3:30 AM on 5 May": ("2026-05-05 02:30", "2026-05-05 04:30", "hour", "both"),
    "at 12am 1 Jan 2026": ("2026-01-01 00:00", "2026-01-01 01:00", "hour", "both"),
    "connections between 1 April and 5 April 2026?": ("2026-04-01", "2026-04-06", "range", "both"),
    "between 30 Dec 2025 and 2 January 2026": ("2025-12-30", "2026-01-03", "range", "both"),
    "between 2026-04-01 and 2026-04-05": ("2026-04-01", "2026-04-06", "range", "both"),
    "SQL errors in the last 6 hours": ("2026-04-21 04:00", "2026-04-21 10:00", "last", "right"),
    "past 2 days": ("2026-04-19 10:00", "2026-04-21 10:00", "last", "right"),
    "CPU trend yesterday": ("2026-04-19 10:00", "2026-04-20 10:00", "yesterday", "both"),
    "everything that happened today": ("2026-04-21", "2026-04-21 10:00", "today", "right"),
    "warnings this week": ("2026-04-19", "2026-04-21 10:00", "week", "right"),
    "Is the disk full?": ("2026-04-20 10:00", "2026-04-21 10:00", "default", "right"),
    "on 20 April 2026 at 3pm": ("2026-04-20 15:00", "2026-04-20 16:00", "hour", "both"),
    "at 14:30 on 20 April 2026": ("2026-04-20 14:30", "2026-04-20 15:30", "hour", "both"),
    "around 20 April 2026 at 0:15": ("2026-04-19 23:15", "2026-04-20 01:15", "hour", "both"),
    "at 25:00 on 20 April 2026": ("2026-04-20 10:00", "2026-04-21 10:00", "default", "right"),
    "last 99999999999999999999 hours": ("2026-04-20 10:00", "2026-04-21 10:00", "default", "right"),
    "last 99999999999 hours": ("2026-04-20 10:00", "2026-04-21 10:00", "default", "right"),
    "last 2000000 days": ("2026-04-20 10:00", "2026-04-21 10:00", "default", "right"),
    "errors on 31 February 2026": ("2026-04-20 10:00", "2026-04-21 10:00", "default", "right"),
}


def test_resolve_window(spark):
    df = spark.createDataFrame([(q,) for q in QUESTIONS], "q string")
    got = {r.q: (r.win_start, r.win_end, r.rule, r.closed)
           for r in e.resolve_window(df, "q", "2026-04-21 10:00:00").collect()}
    for q, (start, end, rule, closed) in QUESTIONS.items():
        assert got[q] == (at(start), at(end) if end else None, rule, closed), q


def test_lint(spark):
    good = 'Event\n| where TimeGenerated > ago(24h)\n| project TimeGenerated, Source\n| take 10'
    bad = 'Perf\n| where CounterName == "Made Up"\n| where ObjectName == "SQLServer:Locks"\n| project Nope\n| take 500'
    flags = ["known_table", "time_filter_first", "capped", "instance_prefix_ok", "known_counters", "known_columns"]
    df = spark.createDataFrame([(0, good), (1, bad)], "i int, t string")
    got = [tuple(r[f] for f in flags) for r in e.lint_queries(df, "t").orderBy("i").collect()]
    assert got == [(True,) * 6, (True, False, False, False, False, False)]


def searches(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString().lower()
    return sum(plan.count(name) for name in ("regexp_", "rlike", "regexp("))


def test_texts_are_searched_once_or_twice(spark):
    df = spark.createDataFrame([("between 5 may and 6 may",)], "t string")
    assert searches(e.resolve_window(df, "t", "2026-04-21 10:00:00")) == 1
    assert searches(e.lint_queries(df, "t")) == 2


def test_hours_belong_to_the_date_they_touch(spark):
    asked = {
        "5 may 2024 10:30 6 may 2024": ("2024-05-06 10:30", "hour"), "5 may 2024 10:30 am 6 may 2024": ("2024-05-06 10:30", "hour"),
        "5 may 2024, at 3PM": ("2024-05-05 15:00", "hour"), "12 am on 2024-05-05": ("2024-05-05 00:00", "hour"),
        "2024-05-05 around 3 pm": ("2024-05-05 14:00", "hour"), "7 may 2024-01-05 1:05PM": ("2024-01-05 13:05", "hour"),
        "5 may 2024 25:00": ("2026-04-20 10:00", "default"), "10:30 today": ("2026-04-21 00:00", "today"),
    }
    df = spark.createDataFrame([(q,) for q in asked] + [(None,)], "q string")
    got = {r.q: (str(r.win_start)[:16], r.rule) for r in e.resolve_window(df, "q", "2026-04-21 10:00:00").collect()}
    assert got == {**asked, None: ("2026-04-20 10:00", "default")}


def test_lint_of_odd_queries(spark):
    queries = [None, "", "Perf|take 50", "Event | summarize x = 1 | project x", "Events | project-away Foo",
               "Event | project A = Source, A,B | extend B=1", "Event | take 51 | take 5"]
    df = spark.createDataFrame(list(enumerate(queries)), "i int, t string")
    got = [tuple(r)[2:] for r in e.lint_queries(df, "t").orderBy("i").collect()]
    assert got[0] == (None,) * 6
    assert [(r[0], r[2], r[5]) for r in got[1:]] == [
        (False, False, True), (True, True, True), (True, True, True), (False, False, True), (True, False, False),
        (True, False, True)]


def test_doc_context_and_caps(spark):
    responses = spark.createDataFrame(
        [("r", 0, DOCS[0]), ("r", 1, DOCS[0]), ("r", 2, DOCS[3]), ("s", 0, DOCS[6])], "k string, n int, body string")
    got = {r.k: (r.doc_count, r.context) for r in documentation(responses, "k", "n", "body").collect()}
    assert got == {"r": (4, "\n".join([
        "1. **A**", "   URL: u1", "   Summary: x y", "",
        "2. **C**", "   URL: u3", "   Summary: s", "",
        "3. **One**", f"   URL: {HOSTED}one", "",
        "4. **Two**", f"   URL: {HOSTED}two", ""]))}
    capped = e.cap_docs(spark.range(9).selectExpr("'k' AS k", "id % 2 AS t", "id AS pos"), "k", "t", "pos")
    assert sorted(r.pos for r in capped.collect()) == [0, 1, 2, 3]


def test_search_terms(spark):
    asked = spark.createDataFrame([("a", "Why the timeout?"), ("c", "Hm")], "g string, q string")
    got = search_terms(asked, "q", rows(spark), "g", "m")
    assert terms(got, ("side", "pos")) == {
        "a": ["SQL Server Why the timeout?", "SQL Server timeout troubleshoot", "SQL Server S1 EventID 911",
              "SQL Server Database X does not exist", "SQL Server Line one is long enough"],
        "b": ["SQL Server S3 EventID 7", "SQL Server This one is certainly longer than twenty"],
        "c": ["SQL Server Hm"],
    }


def test_bodies_and_text_parts(spark):
    bodies = ['data: {"a": 1}\n', ' {"b": 2}\n', "<html>", None]
    assert one_column(spark, bodies, e.any_body("t")) == ['{"a": 1}', '{"b": 2}', None, None]
    parts = ['{"result": {"content": [{"type": "text", "text": "x [A](u)"}, {"type": "image", "text": "no"},'
             ' {"type": "text", "text": "{\\"k\\": 1}"}, {"type": "text"}]}}',
             '{"result": {"content": [{"type": "image"}]}}', '{"items": []}', "plain"]
    assert one_column(spark, parts, e.text_parts("t")) == ['x [A](u)\n{"k": 1}', None, '{"items": []}', "plain"]


def test_trim_is_linear(spark):
    text = "<b>a" + " " * 1_000_000 + "b</b> "
    assert [len(x) for x in one_column(spark, [text], e.strip_html("t"))] == [1_000_002]
