"""String expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timewin import ColumnLike, as_column

# Possessive, and at the end only from where a run begins: linear in the text.
_EDGE_SPACE = r"^[\s\p{Z}]++|(?<![\s\p{Z}])[\s\p{Z}]++$"


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def contains_ci(c: ColumnLike, needle: str) -> Column:
    """Case-insensitive substring; no pattern characters to escape."""
    return F.lower(as_column(c)).contains(needle.lower())


def contains_any(c: ColumnLike, needles: Sequence[str]) -> Column:
    return any_of(contains_ci(c, n) for n in needles)


def any_like(c: ColumnLike, patterns: Sequence[str]) -> Column:
    return any_of(as_column(c).ilike(p) for p in patterns)


def any_col_like(pairs: Iterable[tuple[ColumnLike, str]]) -> Column:
    """OR over (column, pattern) pairs."""
    return any_of(as_column(c).ilike(p) for c, p in pairs)


def strip(c: ColumnLike) -> Column:
    return F.regexp_replace(as_column(c), _EDGE_SPACE, "")


def zero_pad(n: ColumnLike, width: int = 3) -> Column:
    """Rightmost ``width`` characters of the zero-prefixed number; longer ones are cut."""
    padded = F.concat(F.lit("0" * width), as_column(n).cast("string"))
    return F.right(padded, F.lit(width))


def zero_fill(n: ColumnLike, width: int = 3) -> Column:
    """The number with leading zeros up to ``width`` digits; longer ones stay whole."""
    text = as_column(n).cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def preview(c: ColumnLike, width: int = 150) -> Column:
    return F.concat(F.left(as_column(c), F.lit(width)), F.lit("..."))


def strip_html(c: ColumnLike) -> Column:
    """Drop tags by pattern; text between script tags stays."""
    return strip(F.regexp_replace(as_column(c), "<[^>]+>", ""))


def first_sentence(c: ColumnLike, width: int = 120) -> Column:
    head = F.regexp_extract(as_column(c), r"^[^.\n]*", 0)
    return strip(F.left(head, F.lit(width)))


def title_case(c: ColumnLike) -> Column:
    """Capital at the start of every run of letters, also after digits and dots."""
    runs = F.regexp_extract_all(as_column(c), F.lit(r"(\P{L}*\p{L}+|\P{L}+)"), F.lit(1))

    def capital(run: Column) -> Column:
        lead = F.regexp_extract(run, r"^\P{L}*\p{L}?", 0)
        rest = F.substr(run, F.length(lead) + F.lit(1))
        return F.concat(F.upper(lead), F.lower(rest))

    return F.array_join(F.transform(runs, capital), "")


def slug_title(url: ColumnLike) -> Column:
    """Readable title out of the last path segment of a URL."""
    bare = F.regexp_replace(as_column(url), "/+$", "")
    slug = F.regexp_extract(bare, "[^/]*$", 0)
    return title_case(F.replace(slug, F.lit("-"), F.lit(" ")))


def found_keywords(c: ColumnLike, keywords: Sequence[str]) -> Column:
    """Distinct matches in order of first appearance, spelled as found."""
    pattern = "(?i)(" + "|".join(keywords) + ")"
    return F.array_distinct(F.regexp_extract_all(as_column(c), F.lit(pattern), F.lit(1)))


def fenced_block(c: ColumnLike, lang: str = "kql") -> Column:
    """Body of the first fenced block in that language, NULL when there is none."""
    body = F.regexp_extract(as_column(c), rf"(?s)```{lang}\s*(.*?)\s*```", 1)
    return F.nullif(strip(body), F.lit(""))


def choose(index: ColumnLike, *values: Column | str) -> Column:
    """1-based pick; NULL outside the list."""
    i = as_column(index)
    options = F.array(*(F.lit(v) if isinstance(v, str) else v for v in values))
    return F.when(i >= 1, F.try_element_at(options, i.cast("int")))
