"""Search terms, documentation results and reply texts, as jobs over whole columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    fenced_block,
    first_sentence,
    found_keywords,
    slug_title,
    strip,
    strip_html,
)
from ..functions.timewin import ColumnLike, When, as_column, moment, start_of_day, start_of_week, ts_lit
from ..schemas import COUNTERS, EVENT, PERF
from .extremum import fetched, first_of
from .topk import first_per_group

__all__ = [
    "any_body", "cap_docs", "doc_context", "error_terms", "event_ids", "fenced_block", "last_sse", "lint_queries",
    "merge_terms", "parse_docs", "question_terms", "resolve_window", "strip_html", "text_parts",
]

# Search-term prefix, question keywords, documentation host, link patterns and caps.
TERM_PREFIX = "SQL Server "
QUESTION_KEYWORDS = (
    "error", "warning", r"event\s*id", "login fail", "timeout", "deadlock", "backup", "restore",
    "performance", "CPU", "memory", "disk", "connection", "replication",
)
DOC_HOST = r"learn\.microsoft\.com"
PLAIN_TITLE = "Microsoft Learn Documentation"
MARKDOWN_LINK = r"\[([^\]]+)\]\((https?://{host}[^)]+)\)"
HOST_URL = r'https?://{host}[^\s)\]>"]+'
ANY_URL = r'https?://[^\s)\]>"]+'
LISTED_EVENT_ID = r"'EventID':\s*(\d+)"
MAX_TERMS = 3
MAX_ALL_TERMS = 5
MAX_SNIPPETS = 5

_ITEM = (
    "array<struct<title:string,url:string,link:string,description:string,snippet:string,summary:string>>"
)
_DOC = "array<struct<title:string,url:string,description:string>>"


def error_terms(
    df: DataFrame, group: str, order: Sequence[str], k: int = MAX_TERMS,
    levels: Sequence[str] = ("error", "warning"),
) -> DataFrame:
    """Up to ``k`` search terms per result set out of its error and warning rows.

    A row yields an id term and a sentence term. Repeats are dropped by a grouped
    minimum of their position (id terms compare as terms, sentence terms as bare
    sentences), packed into numbers, then a rank limit that is applied before the shuffle.
    """
    desc = F.coalesce(F.col("RenderedDescription"), F.lit(""))
    sentence = first_sentence(desc)
    id_term = strip(
        F.concat(
            F.lit(TERM_PREFIX), F.coalesce(F.col("Source"), F.lit("")),
            F.lit(" EventID "), F.col("EventID").cast("string"),
        )
    )
    by_id = F.when(
        F.coalesce(F.col("EventID"), F.lit(0)) != 0,
        F.struct(F.lit(0).alias("branch"), id_term.alias("seen_as")),
    )
    by_text = F.when(
        (F.length(desc) > 20) & (sentence != ""),
        F.struct(F.lit(1).alias("branch"), sentence.alias("seen_as")),
    )
    candidates = (
        df.filter(F.lower("EventLevelName").isin(*levels))
        .select(group, *order, F.inline(F.array_compact(F.array(by_id, by_text))))
    )
    place = [*order, "branch"]
    first = first_of(candidates, [group, "seen_as"], place, place)
    # what a term is follows from what it was seen as
    term = F.when(F.col("branch") == 0, F.col("seen_as")).otherwise(F.concat(F.lit(TERM_PREFIX), F.col("seen_as")))
    kept = first_per_group(first.withColumn("term", term), [group], [*place, "term"], k)
    return kept.select(group, "term", *place)


def event_ids(c: ColumnLike) -> Column:
    """Fallback terms from raw result text: the first two EventIDs, then distinct."""
    ids = F.regexp_extract_all(as_column(c), F.lit(LISTED_EVENT_ID), F.lit(1))
    terms = F.transform(F.slice(ids, 1, 2), lambda i: F.concat(F.lit(TERM_PREFIX + "EventID "), i))
    return F.array_distinct(terms)


def question_terms(c: ColumnLike, keywords: Sequence[str] = QUESTION_KEYWORDS) -> Column:
    """The question itself (150 characters) and, if any keyword occurs, a keyword term."""
    text = as_column(c)
    main = F.concat(F.lit(TERM_PREFIX), F.left(strip(text), F.lit(150)))
    found = found_keywords(text, keywords)
    extra = F.concat(F.lit(TERM_PREFIX), F.array_join(found, " "), F.lit(" troubleshoot"))
    has_extra = (F.size(found) > 0) & (extra != main)
    return F.array_compact(F.array(main, F.when(has_extra, extra)))


def merge_terms(first: ColumnLike, second: ColumnLike, cap: int = MAX_ALL_TERMS) -> Column:
    """Two term lists, each term once at its first place, at most ``cap``."""
    return F.slice(F.array_distinct(F.concat(as_column(first), as_column(second))), 1, cap)


def _filled(arr: Column) -> Column:
    """NULL for an empty list, so that coalesce moves on."""
    return F.when(F.size(arr) > 0, arr)


def _first_text(*parts: Column) -> Column:
    return F.coalesce(*(F.nullif(p, F.lit("")) for p in parts), F.lit(""))


def _json_docs(text: Column, k: int) -> Column:
    root = F.try_parse_json(text)
    at = lambda path: F.try_variant_get(root, path, _ITEM)
    items = F.coalesce(at("$"), *(_filled(at(f"$.{key}")) for key in ("results", "items", "value")))
    docs = F.transform(
        F.slice(items, 1, k),
        lambda i: F.struct(
            F.coalesce(i["title"], F.lit("")).alias("title"),
            _first_text(i["url"], i["link"]).alias("url"),
            strip_html(_first_text(i["description"], i["snippet"], i["summary"])).alias("description"),
        ),
    )
    return F.filter(docs, lambda d: (d["title"] != "") & (d["url"] != "")).cast(_DOC)


def _markdown_docs(text: Column, k: int, host: str) -> Column:
    link = MARKDOWN_LINK.format(host=host)
    titles = F.regexp_extract_all(text, F.lit(link), F.lit(1))
    urls = F.regexp_extract_all(text, F.lit(link), F.lit(2))
    docs = F.zip_with(
        titles, urls,
        lambda t, u: F.struct(strip(t).alias("title"), strip(u).alias("url"), F.lit("").alias("description")),
    )
    return F.slice(docs, 1, k).cast(_DOC)


def _url_docs(text: Column, k: int, host: str) -> Column:
    urls = F.regexp_extract_all(text, F.lit(HOST_URL.format(host=host)), F.lit(0))
    return F.transform(
        F.slice(urls, 1, k),
        lambda u: F.struct(slug_title(u).alias("title"), u.alias("url"), F.lit("").alias("description")),
    ).cast(_DOC)


def _plain_docs(text: Column, title: str) -> Column:
    url = F.regexp_extract(text, ANY_URL, 0)
    doc = F.struct(
        F.lit(title).alias("title"), url.alias("url"),
        strip(F.left(text, F.lit(300))).alias("description"),
    )
    return F.when((F.length(text) > 50) & (url != ""), F.array(doc)).cast(_DOC)


def parse_docs(c: ColumnLike, k: int = 3, host: str = DOC_HOST, plain_title: str = PLAIN_TITLE) -> Column:
    """Documents in a search response: JSON, else markdown links, else URLs, else plain text."""
    text = as_column(c)
    return F.coalesce(
        _filled(_json_docs(text, k)),
        _filled(_markdown_docs(text, k, host)),
        _filled(_url_docs(text, k, host)),
        _plain_docs(text, plain_title),
        F.array().cast(_DOC),
    )


def cap_docs(df: DataFrame, key: str, term: str, pos: str, k: int = 2) -> DataFrame:
    """The first ``k`` documents of every search term."""
    return first_per_group(df, [key, term], [pos], k)


def unique_docs(df: DataFrame, key: str, order: Sequence[str], cap: int = MAX_SNIPPETS) -> DataFrame:
    """Documents of a request, each URL once at its first place, ``cap`` per request.

    Places are compared without the documents; titles and descriptions are fetched for those kept. At equal places a hash
    of the row decides.
    """
    rest = [c for c in df.columns if c not in (key, "url")]
    rows = df.withColumn("_row", F.xxhash64(*rest))
    place = [*order, "_row"]
    first = first_of(rows, [key, "url"], place, place)
    kept = first_per_group(first, [key], [*place, "url"], cap)
    return fetched(rows, kept, [key, "url", *place]).select(key, "url", *rest)


def doc_context(df: DataFrame, key: str, order: Sequence[str], cap: int = MAX_SNIPPETS) -> DataFrame:
    """One numbered block of text per request, from at most ``cap`` unique documents."""
    kept = unique_docs(df, key, order, cap)
    entry = F.struct(*order, F.col("title"), F.col("url"), F.col("description"))
    # at most ``cap`` entries reach a request's list
    listed = kept.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("docs"))
    lines = F.transform(
        F.col("docs"),
        lambda d, i: F.concat(
            (i + 1).cast("string"), F.lit(". **"), d["title"], F.lit("**\n   URL: "), d["url"],
            F.when(d["description"] != "", F.concat(F.lit("\n   Summary: "), d["description"])).otherwise(""),
            F.lit("\n"),
        ),
    )
    return listed.select(key, F.size("docs").alias("doc_count"), F.array_join(lines, "\n").alias("context"))


def last_sse(c: ColumnLike) -> Column:
    """The last ``data:`` line of an event stream whose payload is valid JSON."""
    lines = F.transform(F.split(as_column(c), "\n"), strip)
    data = F.transform(
        F.filter(lines, lambda s: s.startswith("data:")), lambda s: strip(F.substr(s, F.lit(6)))
    )
    valid = F.filter(data, lambda s: (s != "") & F.try_parse_json(s).isNotNull())
    return F.try_element_at(valid, F.lit(-1))


def any_body(c: ColumnLike) -> Column:
    """The payload of a response: the last one of an event stream, else the body itself if it is JSON."""
    text = strip(c)
    return F.coalesce(last_sse(c), F.when(F.try_parse_json(text).isNotNull(), text))


def text_parts(c: ColumnLike) -> Column:
    """The text parts of a response envelope, one per line; other kinds are skipped.

    NULL without any; a body that is no envelope stays as it is.
    """
    body = as_column(c)
    content = F.try_variant_get(F.try_parse_json(body), "$.result.content", "array<struct<type:string,text:string>>")
    texts = F.transform(
        F.filter(content, lambda p: (p["type"] == "text") & p["text"].isNotNull()), lambda p: p["text"])
    return F.when(content.isNull(), body).when(F.size(texts) > 0, F.array_join(texts, "\n"))


_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_MONTH = (
    "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:tember)?|"
    "oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
_DATE = rf"(?:\d{{1,2}} {_MONTH}(?: \d{{4}})?|\d{{4}}-\d{{2}}-\d{{2}})"

# Minutes that "last N" may go back: a thousand years.
LONGEST_BACK = 1000 * 366 * 1440

_HALVED, _FULL = r"\d{1,2}(?::\d{2})? ?[ap]m", r"\d{1,2}:\d{2}"
_CLOCK = rf"(?:{_HALVED}|{_FULL})"

# All time phrases in one pattern. An hour after a date that a second date follows belongs to that one;
# a date does not end in the year of another that an hour follows.
PHRASES = "(?i)" + "|".join((
    rf"between {_DATE} and {_DATE}",
    rf"\b{_CLOCK}(?: on)? {_DATE}",
    rf"\b{_DATE},?(?: at| around)? {_HALVED}\b(?!(?: on)? {_DATE})",
    rf"\b{_DATE},?(?: at| around)? {_FULL}\b(?!(?: ?[ap]m)?(?: on)? {_DATE})",
    rf"\b{_DATE}(?!-\d{{2}}-\d{{2}},?(?: at| around)? {_CLOCK})",
    r"\b(?:last|past) \d+ (?:minute|hour|day)",
    r"\b(?:yesterday|today|this week)\b",
    r"\b(?:around|approximately)\b",
))
# Kinds of phrases in order of precedence; the last one only widens an hour.
RANGE, HOUR_FIRST, DAY_FIRST, DAY, LAST, WORD, AROUND = range(1, 8)


def _half(word: Column) -> Column:
    return F.coalesce(word.isin("am", "pm"), F.lit(False))


def _clock_ends(word: Column) -> Column:
    return word.contains(":") | word.endswith("am") | word.endswith("pm")


def _kind(phrase: Column) -> Column:
    """The kind of a lower-case phrase, told by its first two words and its last."""
    first, second = F.split_part(phrase, F.lit(" "), F.lit(1)), F.split_part(phrase, F.lit(" "), F.lit(2))
    return (
        F.when(first == "between", RANGE).when(first.isin("last", "past"), LAST)
        .when(first.isin("yesterday", "today", "this"), WORD).when(first.isin("around", "approximately"), AROUND)
        .when(_clock_ends(first) | _half(second), HOUR_FIRST)
        .when(_clock_ends(F.split_part(phrase, F.lit(" "), F.lit(-1))), DAY_FIRST).otherwise(DAY)
    )


def resolve_window(df: DataFrame, text: str, as_of: When) -> DataFrame:
    """Add the time window a question asks for: start, end, rule and closing.

    Relative windows end at ``as_of`` and are strict below (closed "right"); dated windows
    include both ends. Without a time phrase, or with an impossible date, hour or number,
    the last 24 hours apply.

    The text is searched once, for phrases of all kinds; the first one of the best kind
    counts. It is then cut at its blanks, and each date is read once.
    """
    now = moment(as_of)
    c, none = F.col, F.lit(None)
    lexed = df.select(
        "*", F.transform(F.regexp_extract_all(c(text), F.lit(PHRASES), F.lit(0)), F.lower).alias("_phrases"))
    best = lexed.select(
        *df.columns,
        F.exists("_phrases", lambda p: p.contains("around") | p.contains("approximately")).alias("_around"),
        F.array_min(F.transform("_phrases", lambda p, i: F.struct(
            _kind(p).alias("kind"), i.alias("at"), p.alias("phrase")))).alias("_best"),
    )
    worded = best.select(*df.columns, "_around", c("_best.kind").alias("_kind"),
                         F.split("_best.phrase", " ").alias("_words"))

    words, kind = c("_words"), c("_kind")
    n = F.size(words)
    word = lambda i: F.get(words, F.lit(i) if isinstance(i, int) else i)
    cut = lambda begin, count: F.slice(words, begin, F.greatest(count, F.lit(0)))
    is_hour = kind.isin(HOUR_FIRST, DAY_FIRST)
    size = F.when(_half(F.when(kind == HOUR_FIRST, word(1)).otherwise(word(n - 1))), 2).otherwise(1)
    link = F.when(kind == HOUR_FIRST, word(size) == "on").otherwise(word(n - size - 1).isin("at", "around"))
    rest = n - size - F.coalesce(link, F.lit(False)).cast("int")
    and_at = F.array_position(words, "and").cast("int")
    days = (
        F.when(kind == RANGE, cut(F.lit(2), and_at - 2))
        .when(kind == HOUR_FIRST, cut(n - rest + 1, rest))
        .when(kind == DAY_FIRST, F.transform(cut(F.lit(1), rest), lambda w: F.replace(w, F.lit(","), F.lit(""))))
        .when(kind == DAY, words)
    )
    clock = F.when(is_hour, F.array_join(cut(F.when(kind == HOUR_FIRST, 1).otherwise(n - size + 1), size), ""))
    parted = worded.select(
        *df.columns, "_around",
        F.when(kind == RANGE, "range").when(is_hour, "hour").when(kind == DAY, "day").when(kind == LAST, "last")
        .when(kind == WORD, F.array_join(words, " ")).alias("_rule"),
        days.alias("_d1"), F.when(kind == RANGE, cut(and_at + 1, n)).alias("_d2"), clock.alias("_time"),
        F.when(kind == LAST, word(1)).alias("_number"), F.when(kind == LAST, word(2)).alias("_unit"),
    )

    minutes_per = F.when(c("_unit") == "day", 1440).when(c("_unit") == "hour", 60).otherwise(1)
    half = F.when(_half(F.right("_time", F.lit(2))), F.left(F.right("_time", F.lit(2)), F.lit(1)))
    split = parted.select(
        *df.columns, "_rule", "_around", "_d1", "_d2", half.alias("_half"),
        F.when(half.isNotNull(), F.left("_time", F.length("_time") - 2)).otherwise(c("_time")).alias("_time"),
        F.try_multiply(c("_number").try_cast("bigint"), minutes_per.cast("bigint")).alias("_back"),
    )

    def read_day(n: int, other: int | None = None) -> Column:
        """ISO text as it is; day, month name and year put in that form."""
        parts = f"_d{n}"
        month = F.floor((F.instr(F.lit(_MONTHS), F.lower(F.left(F.get(parts, F.lit(1)), F.lit(3)))) + 2) / 3)
        year = F.coalesce(
            F.get(parts, F.lit(2)), F.get(f"_d{other}", F.lit(2)) if other else none, F.lit(str(now.year))
        )
        spelled = F.concat_ws("-", year, month.cast("string"), F.get(parts, F.lit(0)))
        text = F.when(F.size(parts) > 1, spelled).otherwise(F.get(parts, F.lit(0)))
        return F.when(c(parts).isNotNull(), text.try_cast("timestamp_ntz"))

    stated = F.split_part("_time", F.lit(":"), F.lit(1)).try_cast("int")
    minute = F.coalesce(F.split_part("_time", F.lit(":"), F.lit(2)).try_cast("int"), F.lit(0))
    from_hour = (
        F.when(c("_half") == "p", F.pmod(stated, F.lit(12)) * 60 + 720)
        .when(c("_half") == "a", F.pmod(stated, F.lit(12)) * 60)
        .when(stated < 24, stated * 60)
    )
    dated = split.select(
        *df.columns, "_rule", "_around", read_day(1, other=2).alias("_from"), read_day(2).alias("_to"),
        F.when(minute < 60, from_hour + minute).alias("_clock"),
        F.when(c("_back") <= LONGEST_BACK, c("_back").cast("int")).alias("_back"),
    )

    day, hour = F.expr("INTERVAL 1 DAY"), F.expr("INTERVAL 1 HOUR")
    is_ = lambda rule: c("_rule") == rule
    at = c("_from") + F.make_dt_interval(mins="_clock")
    start = (
        F.when(is_("range") | is_("day"), c("_from"))
        .when(is_("hour"), F.when(c("_around"), at - hour).otherwise(at))
        .when(is_("last"), ts_lit(now) - F.make_dt_interval(mins="_back"))
        .when(is_("yesterday"), ts_lit(now - dt.timedelta(days=2)))
        .when(is_("today"), ts_lit(start_of_day(now)))
        .when(is_("this week"), ts_lit(start_of_week(now)))
    )
    end = (
        F.when(is_("range"), c("_to") + day)
        .when(is_("day"), c("_from") + day)
        .when(is_("hour"), at + hour)
        .when(is_("yesterday"), ts_lit(now - dt.timedelta(days=1)))
        .otherwise(ts_lit(now))
    )
    bounded = dated.select(*df.columns, "_rule", start.alias("_start"), end.alias("_end"))
    known = c("_start").isNotNull()
    dated_rule = c("_rule").isin("range", "hour", "day", "yesterday")
    return bounded.select(
        *df.columns,
        F.coalesce("_start", ts_lit(now - dt.timedelta(hours=24))).alias("win_start"),
        F.when(known, c("_end")).otherwise(ts_lit(now)).alias("win_end"),
        F.when(known, F.replace("_rule", F.lit("this "))).otherwise("default").alias("rule"),
        F.when(known & dated_rule, "both").otherwise("right").alias("closed"),
    )


# White space that names of columns are trimmed of.
_BLANKS = " \t\n\r\x0b\x0c\u00a0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
# The steps of a query that its checks look at, and what it names: counters and columns of its own.
STEPS = "|".join((
    r"^\s*(?:Event|Perf)\b(?:\s*\|\s*where TimeGenerated\b)?",
    r"\|\s*project\s+[^|]+",
    r"\|\s*take\s+\d+",
    r"\|\s*summarize\b",
))
NAMES = r'CounterName\s*==\s*"[^"]+"|\w+\s*=(?=[^=~])|\s\w+:(?:double|long|string)'


def lint_queries(df: DataFrame, text: str) -> DataFrame:
    """Flags per query string: does it keep to the known tables, columns and counters?

    The text is searched twice, for its steps and for the names in it; the rest compares words.
    """
    trim = lambda c, more="": F.btrim(c, F.lit(_BLANKS + more))
    found = df.select("*", F.regexp_extract_all(text, F.lit(STEPS), F.lit(0)).alias("_found"),
                      F.regexp_extract_all(text, F.lit(NAMES), F.lit(0)).alias("_names"))
    searched = found.select(
        *df.columns,
        F.get(F.filter("_found", lambda t: ~t.startswith("|")), F.lit(0)).alias("_begin"),
        F.transform(F.filter("_found", lambda t: t.startswith("|")), lambda t: trim(t, "|")).alias("_steps"),
        F.transform(F.filter("_names", lambda t: t.endswith('"')), lambda t: F.split_part(
            t, F.lit('"'), F.lit(2))).alias("_counters"),
        F.transform(F.filter("_names", lambda t: ~t.endswith('"')), lambda t: trim(F.split_part(
            trim(t, "="), F.lit(":"), F.lit(1)))).alias("_created"),
    )
    first = lambda step: F.substr(F.get(F.filter(
        "_steps", lambda t: t.startswith(step)), F.lit(0)), F.lit(len(step) + 1))
    columns = F.filter(F.transform(F.split(first("project"), ","), lambda c: trim(c)), lambda c: c != "")
    known = F.array(*(F.lit(c) for c in sorted(set(EVENT.names) | set(PERF.names))))
    counters = F.array(*(F.lit(name) for _, name in COUNTERS))
    asked = F.col(text).isNotNull()
    return searched.select(
        *df.columns,
        F.when(asked, F.col("_begin").isNotNull()).alias("known_table"),
        F.when(asked, F.coalesce(F.col("_begin").endswith("TimeGenerated"), F.lit(False))).alias("time_filter_first"),
        (F.coalesce(trim(first("take")).try_cast("int") <= 50, F.lit(False))
         | F.array_contains("_steps", "summarize")).alias("capped"),
        (~F.col(text).contains("SQLServer:")).alias("instance_prefix_ok"),
        F.when(asked, F.size(F.array_except("_counters", counters)) == 0).alias("known_counters"),
        F.when(asked, F.coalesce(F.size(F.array_except(F.array_except(columns, known), "_created")) == 0, F.lit(True)))
        .alias("known_columns"),
    )
