"""From questions and result rows to the documentation searched for them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.enrichment import (
    MAX_ALL_TERMS,
    QUESTION_KEYWORDS,
    cap_docs,
    doc_context,
    error_terms,
    parse_docs,
    question_terms,
)
from ..operators.topk import union_first_seen


def search_terms(
    questions: DataFrame, text: str, results: DataFrame, key: str, order: str,
    keywords: Sequence[str] = QUESTION_KEYWORDS, cap: int = MAX_ALL_TERMS,
) -> DataFrame:
    """Search terms per request: those of its question, then those of its error rows."""
    asked = questions.select(key, F.posexplode(question_terms(text, keywords)).alias("pos", "term"))
    found = error_terms(results, key, [order]).select(
        key, F.struct(order, "branch").alias("at"), "term"
    )
    # error terms are at most three per request, so ranking them costs nothing
    ranked = found.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "term"))).alias("l")).select(
        key, F.posexplode("l").alias("pos", "e")
    )
    return union_first_seen(asked, ranked.select(key, "pos", F.col("e.term").alias("term")), key, "term", "pos", cap)


def documentation(
    responses: DataFrame, key: str, term: str, body: str, per_term: int = 2, **how: object
) -> DataFrame:
    """Context block per request out of raw search responses, one row per (request, term)."""
    docs = responses.select(key, term, F.posexplode(parse_docs(body, **how)).alias("pos", "doc")).select(
        key, term, "pos", "doc.*"
    )
    kept = cap_docs(docs, key, term, "pos", per_term)
    return doc_context(kept, key, [term, "pos"])
