"""Text and enrichment jobs over documents, conversations, pages, events and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import enrichment as e
from ..plans.answers import documentation, search_terms
from .bindings import Sample, over
from .registry import query

_STRIP = "regexp_replace({0}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')"


def _strip(expr: str) -> str:
    return _STRIP.format(expr)


def _sentence(expr: str) -> str:
    return _strip(f"left(regexp_extract({expr}, '^[^.\\n]*'), 120)")


def _terms_sql(rows: str, group: str, order: str) -> str:
    """First-seen terms as ranked windows; ``rows`` yields group, order, src, id and d."""
    return f"""rows_ AS ({rows}), cand AS (
  SELECT {group}, {order}, 0 AS branch, concat('SQL Server ', src, ' EventID ', id) AS seen_as,
  concat('SQL Server ', src, ' EventID ', id) AS term FROM rows_ WHERE id <> 0
  UNION ALL SELECT {group}, {order}, 1, fs, concat('SQL Server ', fs) FROM (
  SELECT *, {_sentence('d')} AS fs FROM rows_) WHERE length(d) > 20 AND fs <> ''),
  firsts AS (SELECT *, row_number() OVER (PARTITION BY {group}, seen_as ORDER BY {order}, branch) AS rn FROM cand),
  terms AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {order}, branch) AS place FROM firsts
  WHERE rn = 1)"""


_LOG_TERMS = _terms_sql(
    "SELECT Computer, TimeGenerated, Source AS src, EventID AS id, RenderedDescription AS d FROM log "
    "WHERE EventLevelName IN ('Error', 'Warning')", "Computer", "TimeGenerated",
)

query("txt05_error_terms", over("log").rstrip() + ", " + _LOG_TERMS + """
  SELECT Computer, term, TimeGenerated, branch FROM terms WHERE place <= 3""")(
    lambda s: e.error_terms(s.log, "Computer", ["TimeGenerated"]))


def _document_rows(s: Sample) -> DataFrame:
    return s.table("documents").select(
        "lang", "doc_id", F.col("source").alias("Source"), F.col("doc_id").alias("EventID"),
        F.col("text").alias("RenderedDescription"),
        F.when(F.col("doc_id") % 2 == 0, "Error").otherwise("Warning").alias("EventLevelName"),
    )


query("txt05_document_terms", "WITH " + _terms_sql(
    "SELECT lang, doc_id, source AS src, doc_id AS id, text AS d FROM documents",
    "lang", "doc_id") + " SELECT lang, term, doc_id, branch FROM terms WHERE place <= 40")(
    lambda s: e.error_terms(_document_rows(s), "lang", ["doc_id"], 40))

_RAW = ("concat('[{', chr(39), 'EventID', chr(39), ': ', cast(user_id % 4 as string), '}, {', chr(39), 'EventID', "
        "chr(39), ': ', cast(event_id % 4 as string), '}, {', chr(39), 'EventID', chr(39), ': 7}]')")

query("txt06_fallback_event_ids", """SELECT event_id, CASE WHEN user_id % 4 = event_id % 4
  THEN concat('SQL Server EventID ', user_id % 4)
  ELSE concat('SQL Server EventID ', user_id % 4, '|SQL Server EventID ', event_id % 4) END AS terms FROM events""")(
    lambda s: s.table("events").select(
        "event_id", F.array_join(e.event_ids(F.expr(_RAW)), "|").alias("terms")))

# A list of events whose descriptions are the documents themselves
_LISTED = """concat('[{', chr(39), 'EventID', chr(39), ': ', cast(n_chars as string), ', ', chr(39), 'Text', chr(39),
  ': ', chr(39), coalesce(text, ''), chr(39), '}, {', chr(39), 'EventID', chr(39), ':', cast(doc_id % 50 as string), '}]')"""

query("txt06_event_ids_of_documents", """SELECT doc_id, CASE WHEN n_chars = doc_id % 50
  THEN concat('SQL Server EventID ', n_chars)
  ELSE concat('SQL Server EventID ', n_chars, '|SQL Server EventID ', doc_id % 50) END AS terms FROM documents""")(
    lambda s: s.table("documents").select(
        "doc_id", F.array_join(e.event_ids(F.expr(_LISTED)), "|").alias("terms")))

# Tokens that do occur in the sample conversations.
KEYWORDS = ("the", "que", r"ment\w*", "der")
_FOUND = "regexp_extract_all(text, '(?i)(the|que|ment\\w*|der)', 1)"
_DISTINCT = "list_filter({0}, lambda x, i: list_position({0}, x) = i)"
_MAIN = f"concat('SQL Server ', left({_strip('text')}, 150))"
_EXTRA = f"concat('SQL Server ', array_to_string({_DISTINCT.format(_FOUND)}, ' '), ' troubleshoot')"
_QUESTION = f"""CASE WHEN len({_FOUND}) > 0 AND {_EXTRA} <> {_MAIN} THEN [{_MAIN}, {_EXTRA}]
  ELSE [{_MAIN}] END"""

query("txt07_question_terms", f"""SELECT conv_id, turn, array_to_string({_QUESTION}, '|') AS terms
  FROM conversations""")(
    lambda s: s.table("conversations").select(
        "conv_id", "turn", F.array_join(e.question_terms("text", KEYWORDS), "|").alias("terms")))


def _other_terms():
    return F.array(
        F.concat(F.lit("SQL Server "), "role"), F.concat(F.lit("SQL Server "), F.col("turn").cast("string")),
        F.concat(F.lit("SQL Server "), "role"), F.lit("SQL Server backup"), F.lit("SQL Server restore"),
    )


query("txt08_merge_terms", f"""SELECT conv_id, turn, array_to_string(list_slice({_DISTINCT.format('l')}, 1, 5), '|')
  AS terms FROM (SELECT conv_id, turn, list_concat({_QUESTION}, [concat('SQL Server ', role),
  concat('SQL Server ', turn), concat('SQL Server ', role), 'SQL Server backup', 'SQL Server restore']) AS l
  FROM conversations)""")(
    lambda s: s.table("conversations").select(
        "conv_id", "turn",
        F.array_join(e.merge_terms(e.question_terms("text", KEYWORDS), _other_terms()), "|").alias("terms")))


def _asked(s: Sample) -> DataFrame:
    return s.log.groupBy("Computer").agg(
        F.concat(F.lit("Why did Login failed errors hit "), "Computer", F.lit(" before a timeout?")).alias("question")
    )


query("txt08_search_terms_per_request", over("log").rstrip() + ", " + _LOG_TERMS + """, both_ AS (
  SELECT Computer, 0 AS side, 0 AS pos, concat('SQL Server Why did Login failed errors hit ', Computer,
  ' before a timeout?') AS term FROM (SELECT DISTINCT Computer FROM log)
  UNION ALL SELECT DISTINCT Computer, 0, 1, 'SQL Server Login fail error timeout troubleshoot' FROM log
  UNION ALL SELECT Computer, 1, place - 1, term FROM terms WHERE place <= 3), seen AS (
  SELECT *, row_number() OVER (PARTITION BY Computer, term ORDER BY side, pos) AS rn FROM both_), placed AS (
  SELECT *, row_number() OVER (PARTITION BY Computer ORDER BY side, pos) AS p FROM seen WHERE rn = 1)
  SELECT Computer, term, side, pos FROM placed WHERE p <= 5""")(
    lambda s: search_terms(_asked(s), "question", s.log, "Computer", "TimeGenerated"))


# Search responses built out of whole pages: JSON, markdown, bare links and plain text

_RAW_TITLE = "regexp_extract(html, '<title>([^<]*)</title>', 1)"
_TITLE = "regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '[^A-Za-z0-9 ]', '_'{g})"
_LONG = "A long passage that names no known host but is more than fifty characters long, see http://other.test/x"


def _body(g: str) -> str:
    t = _TITLE.format(g=g)
    return f"""CASE page_id % 4
  WHEN 0 THEN to_json(named_struct('results', array(
    named_struct('title', {_RAW_TITLE}, 'url', url, 'link', cast(null as string), 'description', html,
      'snippet', cast(null as string)),
    named_struct('title', '', 'url', url, 'link', null, 'description', null, 'snippet', null),
    named_struct('title', 'Second', 'url', null, 'link', concat(url, '/two'), 'description', null,
      'snippet', 'more'))))
  WHEN 1 THEN concat('See [', {t}, '](', url, ') and [More](', url, '/more).')
  WHEN 2 THEN concat('Visit ', url, ' now or ', url, '/how-to-2fix.it-quickly/ later')
  ELSE concat('{_LONG} in ', {_RAW_TITLE}) END"""


HOST = r"[a-z0-9.-]*example\.(?:com|net|org)"
_CASE = """array_to_string(list_transform(regexp_extract_all({0}, '(\\P{{L}}*\\p{{L}}+|\\P{{L}}+)'), lambda r:
  concat(upper(regexp_extract(r, '^\\P{{L}}*\\p{{L}}?')),
  lower(substr(r, length(regexp_extract(r, '^\\P{{L}}*\\p{{L}}?')) + 1)))), '')"""
_SLUG = _CASE.format("replace(regexp_extract(regexp_replace(u, '/+$', ''), '[^/]*$'), '-', ' ')")
_T = _TITLE.format(g=", 'g'")
_DOCS_SQL = f"""docs AS (
  SELECT page_id, 0 AS pos, raw AS title, url, {_strip("regexp_replace(html, '<[^>]+>', '', 'g')")} AS description FROM src WHERE f = 0
  AND raw <> '' UNION ALL SELECT page_id, CASE WHEN raw = '' THEN 0 ELSE 1 END, 'Second', concat(url, '/two'), 'more'
  FROM src WHERE f = 0
  UNION ALL SELECT page_id, 0, {_strip('t')}, url, '' FROM src WHERE f = 1 AND t <> ''
  UNION ALL SELECT page_id, CASE WHEN t = '' THEN 0 ELSE 1 END, 'More', concat(url, '/more'), '' FROM src
  WHERE f = 1
  UNION ALL SELECT page_id, pos, {_SLUG}, u, '' FROM (SELECT page_id, 0 AS pos, url AS u FROM src WHERE f = 2
  UNION ALL SELECT page_id, 1, concat(url, '/how-to-2fix.it-quickly/') FROM src WHERE f = 2)
  UNION ALL SELECT page_id, 0, 'Microsoft Learn Documentation', 'http://other.test/x',
  {_strip(f"left(concat('{_LONG} in ', raw), 300)")} FROM src WHERE f = 3)"""
_SRC_SQL = f"WITH src AS (SELECT page_id, url, html, {_T} AS t, {_RAW_TITLE} AS raw, page_id % 4 AS f FROM pages), "


def _responses(s: Sample) -> DataFrame:
    return s.table("pages").select("page_id", F.expr(_body("")).alias("body"))


query("txt09_parse_docs", _SRC_SQL + _DOCS_SQL + " SELECT page_id, pos, title, url, description FROM docs")(
    lambda s: _responses(s).select("page_id", F.posexplode(e.parse_docs("body", host=HOST)).alias("pos", "doc"))
    .select("page_id", "pos", "doc.*"))

query("txt10_strip_html", f"""SELECT page_id, {_strip("regexp_replace(html, '<[^>]+>', '', 'g')")} AS text
  FROM pages""")(lambda s: s.table("pages").select("page_id", e.strip_html("html").alias("text")))

_DOC_ROWS = {
    "source": "source",
    "doc_id": "doc_id",
    "url": "concat('https://', lang, '.example/', cast(cast(n_chars / 200 as int) as string))",
    "title": "concat('Document ', cast(doc_id as string))",
}


def _context_sql(from_: str, key: str, order: str) -> str:
    return f"""firsts AS (SELECT *, row_number() OVER (PARTITION BY {key}, url ORDER BY {order}) AS rn FROM {from_}),
  kept AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS n FROM firsts WHERE rn = 1)
  SELECT {key}, count(*) AS doc_count, string_agg(concat(n, '. **', title, '**\n   URL: ', url,
  CASE WHEN description <> '' THEN concat('\n   Summary: ', description) ELSE '' END, '\n'), '\n' ORDER BY n)
  AS context FROM kept WHERE n <= 5 GROUP BY {key}"""


query("txt11_doc_context", "WITH d AS (SELECT source, doc_id, concat('https://', lang, '.example/', "
      "cast(n_chars // 200 as varchar)) AS url, concat('Document ', doc_id) AS title, "
      f"{_sentence('text')} AS description FROM documents), " + _context_sql("d", "source", "doc_id"))(
    lambda s: e.doc_context(
        s.table("documents").selectExpr(
            *(f"{x} AS {n}" for n, x in _DOC_ROWS.items()), "text").select(
            *_DOC_ROWS, e.first_sentence("text").alias("description")),
        "source", ["doc_id"]))

query("txt11_documentation_per_request", _SRC_SQL + _DOCS_SQL + f""", ranked AS (
  SELECT regexp_extract(url, '^https?://([^/]*)', 1) AS host, page_id, pos, title, url, description,
  row_number() OVER (PARTITION BY page_id ORDER BY pos) AS r FROM docs), d AS (
  SELECT p.h AS request, ranked.* FROM ranked JOIN (
  SELECT page_id, regexp_extract(url, '^https?://([^/.]*)', 1) AS h FROM pages) p USING (page_id) WHERE r <= 2),
  """ + _context_sql("d", "request", "page_id, pos"))(
    lambda s: documentation(
        s.table("pages").select(
            F.regexp_extract("url", r"^https?://([^/.]*)", 1).alias("request"), "page_id",
            F.expr(_body("")).alias("body")),
        "request", "page_id", "body", host=HOST))

_SSE = """CASE event_type WHEN 'click' THEN concat('event: ping', chr(10), chr(10))
  WHEN 'view' THEN concat('data: ', props, chr(10), 'data: [DONE', chr(10))
  ELSE concat('event: message', chr(10), '  data: {"first": 1}', chr(10), 'data:', props, chr(10),
  'data: {broken', chr(10), 'data:', chr(10)) END"""

query("txt12_last_sse", """SELECT event_id, CASE WHEN event_type <> 'click' THEN props END AS payload
  FROM events""")(
    lambda s: s.table("events").select("event_id", e.last_sse(F.expr(_SSE)).alias("payload")))

_REPLY = """CASE WHEN role = 'assistant' THEN concat('Here it is:', chr(10), '```kql', chr(10), text, chr(10),
  '```', chr(10), 'or', chr(10), '```kql', chr(10), 'Perf', chr(10), '```') ELSE text END"""

query("txt13_fenced_block", f"""SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN {_strip('text')} END AS kql
  FROM conversations""")(
    lambda s: s.table("conversations").select("conv_id", "turn", e.fenced_block(F.expr(_REPLY)).alias("kql")))


# Questions with every kind of time phrase, built from the order dates

_ASK = """CASE o_orderpriority
  WHEN '1-URGENT' THEN 'Why did errors happen on {day}?'
  WHEN '2-HIGH' THEN CASE WHEN o_custkey % 2 = 0 THEN 'Tell me the latest log around {hour}:30pm {day}'
    ELSE 'Tell me the latest log on {hour}:30pm {day}' END
  WHEN '3-MEDIUM' THEN CASE o_custkey % 3 WHEN 0 THEN 'Show errors of the last {n} hours'
    WHEN 1 THEN 'Show errors of the last {n} days' ELSE 'Show errors of the past {n} minutes' END
  WHEN '4-NOT SPECIFIED' THEN 'How many connections between {day} and {next}?'
  ELSE CASE o_custkey % 5 WHEN 0 THEN 'What happened yesterday?' WHEN 1 THEN 'Summary of today'
    WHEN 2 THEN 'Warnings this week' WHEN 3 THEN 'Logs for {iso}' ELSE 'Any deadlocks?' END END"""
_SPARK_ASK = _ASK
for _name, _expr in {
    "day": "date_format(o_orderdate, 'd MMMM yyyy')",
    "next": "date_format(date_add(o_orderdate, 4), 'd MMMM yyyy')",
    "iso": "cast(cast(o_orderdate as date) as string)",
    "hour": "cast(o_custkey % 12 + 1 as string)",
    "n": "cast(o_custkey % 9 + 1 as string)",
}.items():
    _SPARK_ASK = f"replace({_SPARK_ASK}, '{{{_name}}}', {_expr})"
_NOW = "timestamp '2024-01-31 10:00:00'"
_H = "interval 1 hour"
_AT = "(o_orderdate + to_hours(CASE WHEN o_custkey % 12 + 1 = 12 THEN 12 ELSE o_custkey % 12 + 13 END) + interval 30 minute)"

query("txt14_question_windows", f"""SELECT o_orderkey,
  CASE o_orderpriority WHEN '1-URGENT' THEN o_orderdate
  WHEN '2-HIGH' THEN CASE WHEN o_custkey % 2 = 0 THEN {_AT} - {_H} ELSE {_AT} END
  WHEN '3-MEDIUM' THEN {_NOW} - CASE o_custkey % 3 WHEN 0 THEN to_hours(o_custkey % 9 + 1)
    WHEN 1 THEN to_hours(24 * (o_custkey % 9 + 1)) ELSE to_minutes(o_custkey % 9 + 1) END
  WHEN '4-NOT SPECIFIED' THEN o_orderdate
  ELSE CASE o_custkey % 5 WHEN 0 THEN {_NOW} - interval 2 day WHEN 1 THEN timestamp '2024-01-31'
    WHEN 2 THEN timestamp '2024-01-28' WHEN 3 THEN o_orderdate ELSE {_NOW} - interval 24 hour END END AS win_start,
  CASE o_orderpriority WHEN '1-URGENT' THEN o_orderdate + interval 1 day WHEN '2-HIGH' THEN {_AT} + {_H}
  WHEN '4-NOT SPECIFIED' THEN o_orderdate + interval 5 day
  WHEN '5-LOW' THEN CASE o_custkey % 5 WHEN 0 THEN {_NOW} - interval 1 day
    WHEN 3 THEN o_orderdate + interval 1 day ELSE {_NOW} END ELSE {_NOW} END AS win_end,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'day' WHEN '2-HIGH' THEN 'hour' WHEN '3-MEDIUM' THEN 'last'
  WHEN '4-NOT SPECIFIED' THEN 'range' ELSE CASE o_custkey % 5 WHEN 0 THEN 'yesterday' WHEN 1 THEN 'today'
  WHEN 2 THEN 'week' WHEN 3 THEN 'day' ELSE 'default' END END AS rule,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '4-NOT SPECIFIED')
  OR (o_orderpriority = '5-LOW' AND o_custkey % 5 IN (0, 3)) THEN 'both' ELSE 'right' END AS closed FROM orders""")(
    lambda s: e.resolve_window(
        s.table("orders").select("o_orderkey", F.expr(_SPARK_ASK).alias("question")), "question",
        "2024-01-31 10:00:00").drop("question"))

# Time phrases between whole texts of conversations, which hold none themselves

_PHRASE_DAY = "date_add(date'2023-01-01', cast(conv_id % 700 as int))"
_TALK = f"""concat(coalesce(text, ''), '. ', CASE (conv_id * 7 + turn) % 9
  WHEN 0 THEN concat('on ', date_format({_PHRASE_DAY}, 'd MMMM yyyy'))
  WHEN 1 THEN concat(CASE WHEN conv_id % 2 = 0 THEN 'Around ' ELSE 'at ' END, cast(conv_id % 11 + 1 as string),
    ':30PM on ', date_format({_PHRASE_DAY}, 'd MMM yyyy'))
  WHEN 2 THEN concat(date_format({_PHRASE_DAY}, 'd MMMM yyyy'), ', at ', cast(conv_id % 24 as string), ':15')
  WHEN 3 THEN concat('the LAST ', cast(turn % 5 + 1 as string), ' hours, not 10:30')
  WHEN 4 THEN concat('between ', date_format({_PHRASE_DAY}, 'd MMMM'), ' and ', date_format(date_add({_PHRASE_DAY}, 3), 'd MMMM yyyy'))
  WHEN 5 THEN 'Yesterday, or in the last days,' WHEN 6 THEN 'this week or today'
  WHEN 7 THEN concat(cast({_PHRASE_DAY} as string), ' or yesterday') ELSE 'or' END, ' ', coalesce(text, ''))"""

query("txt14_windows_in_conversations", f"""WITH t AS (SELECT conv_id, turn, (conv_id * 7 + turn) % 9 AS k,
  CAST(DATE '2023-01-01' + CAST(conv_id % 700 AS INTEGER) AS TIMESTAMP) AS d FROM conversations), b AS (SELECT *,
  CASE k WHEN 1 THEN d + to_hours(conv_id % 11 + 13) + interval 30 minute
  WHEN 2 THEN d + to_hours(conv_id % 24) + interval 15 minute
  WHEN 4 THEN d + to_years(CAST(year(d + interval 3 day) - year(d) AS INTEGER)) ELSE d END AS hit FROM t)
  SELECT conv_id, turn, CASE k WHEN 1 THEN hit - to_hours(CASE WHEN conv_id % 2 = 0 THEN 1 ELSE 0 END)
  WHEN 3 THEN {_NOW} - to_hours(turn % 5 + 1) WHEN 5 THEN {_NOW} - interval 2 day WHEN 6 THEN timestamp '2024-01-28'
  WHEN 8 THEN {_NOW} - interval 24 hour ELSE hit END AS win_start,
  CASE k WHEN 1 THEN hit + {_H} WHEN 2 THEN hit + {_H} WHEN 4 THEN d + interval 4 day WHEN 5 THEN {_NOW} - interval 1 day
  WHEN 0 THEN d + interval 1 day WHEN 7 THEN d + interval 1 day ELSE {_NOW} END AS win_end,
  CASE k WHEN 0 THEN 'day' WHEN 1 THEN 'hour' WHEN 2 THEN 'hour' WHEN 3 THEN 'last' WHEN 4 THEN 'range'
  WHEN 5 THEN 'yesterday' WHEN 6 THEN 'week' WHEN 7 THEN 'day' ELSE 'default' END AS rule,
  CASE WHEN k IN (3, 6, 8) THEN 'right' ELSE 'both' END AS closed FROM b""")(
    lambda s: e.resolve_window(
        s.table("conversations").select("conv_id", "turn", F.expr(_TALK).alias("question")), "question",
        "2024-01-31 10:00:00").drop("question"))

_K = "cast(regexp_extract(props, '([0-9]+)', 1) as int)"
_QUERY_TEXT = f"""CASE event_type
  WHEN 'error' THEN concat('Event | where TimeGenerated > ago(24h) | project TimeGenerated, Source | take ',
    cast({_K} as string))
  WHEN 'view' THEN 'Perf | where CounterName == "User Connections" | where TimeGenerated > ago(1h) | summarize AvgV = avg(CounterValue) by bin(TimeGenerated, 1h)'
  WHEN 'signup' THEN 'Logs | where TimeGenerated > ago(1h) | project Foo, Source'
  WHEN 'purchase' THEN 'Perf | where TimeGenerated > ago(1h) | where ObjectName == "SQLServer:Locks" and CounterName == "Bad Counter"'
  ELSE 'Event | where TimeGenerated > ago(24h) | parse RenderedDescription with * "took " Duration:double " seconds" * | project TimeGenerated, Duration, RenderedDescription | take 5'
  END"""

query("txt15_lint_queries", f"""SELECT event_id, event_type <> 'signup' AS known_table,
  event_type IN ('error', 'purchase', 'click') AS time_filter_first,
  CASE event_type WHEN 'error' THEN {_K} <= 50 WHEN 'view' THEN true WHEN 'click' THEN true ELSE false END AS capped,
  event_type <> 'purchase' AS instance_prefix_ok, event_type <> 'purchase' AS known_counters,
  event_type <> 'signup' AS known_columns FROM events""")(
    lambda s: e.lint_queries(
        s.table("events").select("event_id", F.expr(_QUERY_TEXT).alias("text")), "text").drop("text"))

# Queries that look for whole documents: quotes and bars of the texts are left out, as they would end a string or step
_LOOKUP = """concat(CASE WHEN lang IN ('en', 'de') THEN 'Event' ELSE initcap(coalesce(lang, 'und')) END,
  CASE WHEN doc_id % 3 = 0 THEN ' | where Source == "x"' ELSE '' END, chr(10), '| where TimeGenerated > ago(24h)', chr(10),
  '| where RenderedDescription contains "', translate(coalesce(text, ''), '|"=', '   '), '"', chr(10),
  CASE WHEN doc_id % 5 = 0 THEN '| where CounterName == "User Connections"' ELSE '' END,
  CASE WHEN doc_id % 7 = 0 THEN '| where CounterName=="Pages" and ObjectName == "SQLServer:Locks"' ELSE '' END,
  '| project Source, ', CASE WHEN doc_id % 4 = 0 THEN 'Chars = ' ELSE '' END, 'n_', coalesce(lang, 'und'), chr(10),
  CASE WHEN doc_id % 4 < 2 THEN concat('| extend n_', coalesce(lang, 'und'), ' = Computer, Chars = 1') ELSE '' END,
  CASE WHEN doc_id % 11 = 0 THEN '| summarize count()' ELSE concat('| take ', cast(coalesce(n_chars, 0) as string)) END)"""

query("txt15_lint_document_queries", """SELECT doc_id, coalesce(lang IN ('en', 'de'), false) AS known_table,
  coalesce(lang IN ('en', 'de'), false) AND doc_id % 3 <> 0 AS time_filter_first, doc_id % 11 = 0 OR coalesce(n_chars, 0) <= 50 AS capped,
  doc_id % 7 <> 0 AS instance_prefix_ok, doc_id % 7 <> 0 AS known_counters, doc_id % 4 = 1 AS known_columns
  FROM documents""")(
    lambda s: e.lint_queries(
        s.table("documents").select("doc_id", F.expr(_LOOKUP).alias("text")), "text").drop("text"))

query("txt16_docs_per_term", """SELECT lang, source, doc_id FROM (SELECT lang, source, doc_id,
  row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) AS rn FROM documents) WHERE rn <= 2""")(
    lambda s: e.cap_docs(s.table("documents").select("lang", "source", "doc_id"), "lang", "source", "doc_id"))



# Whole responses: streams or plain JSON around an envelope of typed parts

_STREAM = "concat('event: message', chr(10), 'data: ', {0}, chr(10), chr(10))"
_ANY = f"""CASE page_id % 3 WHEN 0 THEN {_STREAM.format("to_json(named_struct('html', html))")}
  WHEN 1 THEN concat(chr(10), to_json(named_struct('html', html)), ' ') ELSE concat('Bad gateway ', url) END"""

query("txt12_any_body", "SELECT page_id, CASE WHEN page_id % 3 < 2 THEN html END AS html FROM pages")(
    lambda s: s.table("pages").select("page_id", F.expr(_ANY).alias("body")).select(
        "page_id", F.get_json_object(e.any_body("body"), "$.html").alias("html")))


def _envelope(*parts: str) -> str:
    """A response of (kind, text) parts given as SQL."""
    return f"to_json(named_struct('result', named_struct('content', array({', '.join(parts)}))))"


def _part(kind: str, text: str) -> str:
    return f"named_struct('type', '{kind}', 'text', {text})"


_TWO = _envelope(_part("text", "url"), _part("image", "'https://images.example.com/skip'"), _part("text", "html"))
_NONE = _envelope(_part("image", "url"))

query("txt16_text_parts", """SELECT page_id, CASE page_id % 3 WHEN 0 THEN concat(url, chr(10), html)
  WHEN 1 THEN NULL ELSE concat('plain ', url) END AS text FROM pages""")(
    lambda s: s.table("pages").select("page_id", F.expr(
        f"CASE page_id % 3 WHEN 0 THEN {_TWO} WHEN 1 THEN {_NONE} ELSE concat('plain ', url) END").alias("body")).select(
        "page_id", e.text_parts("body").alias("text")))

_SEE = f"concat('See [', {_TITLE.format(g='')}, '](', url, ') and [More](', url, '/more).')"
_CHAIN = _STREAM.format(_envelope(
    _part("image", "'[Skip](https://images.example.com/skip)'"), _part("text", "'Found:'"), _part("text", _SEE)))

query("txt16_response_chain", _SRC_SQL + f"""links AS (
  SELECT page_id, 0 AS pos, {_strip('t')} AS title, url, '' AS description FROM src WHERE t <> ''
  UNION ALL SELECT page_id, CASE WHEN t = '' THEN 0 ELSE 1 END, 'More', concat(url, '/more'), '' FROM src), d AS (
  SELECT h AS request, links.* FROM links JOIN (
  SELECT page_id, regexp_extract(url, '^https?://([^/.]*)', 1) AS h FROM pages) p USING (page_id)), """
      + _context_sql("d", "request", "page_id, pos"))(
    lambda s: documentation(
        s.table("pages").select(
            F.regexp_extract("url", r"^https?://([^/.]*)", 1).alias("request"), "page_id",
            e.text_parts(e.any_body(F.expr(_CHAIN))).alias("body")),
        "request", "page_id", "body", host=HOST))
