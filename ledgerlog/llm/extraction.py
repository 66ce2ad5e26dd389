"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into blocks at block-level tags. Each block has its word count and link density,
those of its neighbours, and whether it stands in the article or in a container that tag or
class names mark as menu, advert, comment and the like. The tree is grown from the labelled
table below.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import pieces

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea template iframe select button svg".split())
#: Of these an end tag that is missing is the end of the page; the others hold text then.
ENDLESS = frozenset("script style".split())
#: The next of these ends the one before, which then had no end tag.
UNNESTED = frozenset("button select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr img math mi mn mo ms mtext mrow msup msub mfrac "
                   "msqrt object".split())
CONTENT_TAGS = frozenset(["article", "main"])
BOILER_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
#: Class and id words that mark a container; soft ones do not within the article or beside content words.
STRONG = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promoted comment comments "
                   "reply replies disqus sidebar cookie cookies consent gdpr notice notices newsletter subscribe signup "
                   "popup modal share sharing social related recommended pagination pager breadcrumb breadcrumbs nav "
                   "navbar navigation menu widget".split())
SOFT = frozenset("header footer masthead banner toolbar topbar alert search login legal copyright".split())
CONTENT = frozenset("article post entry content story main body text".split())

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|</?([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)"
    r"|<[/!?][^>]*+(?:>|\Z)", re.S)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
#: Tags that the next of their kind closes.
_SIBLINGS = frozenset("li dt dd tr td th option".split())

#: container is 0 within boilerplate, 1 outside the article of a page that has one, 2 on a page without, 3 within it.
FEATURES = ("container", "words", "link_density", "words_before", "link_density_before", "words_after",
            "link_density_after")
#: Labelled blocks in the order of FEATURES, then 1 for main text.
LABELLED = [
    # menus, adverts, notices, forms, comments and footers by their container
    (0, 1, 1.0, 0, 0.0, 1, 1.0, 0), (0, 1, 1.0, 1, 1.0, 1, 1.0, 0), (0, 7, 0.0, 1, 1.0, 12, 0.0, 0),
    (0, 30, 0.0, 45, 0.0, 0, 0.0, 0), (0, 25, 0.0, 60, 0.0, 40, 0.0, 0), (0, 4, 0.8, 50, 0.0, 3, 1.0, 0),
    (0, 45, 0.0, 60, 0.0, 38, 0.0, 0), (0, 12, 0.1, 80, 0.0, 0, 0.0, 0), (0, 3, 0.0, 40, 0.0, 5, 0.2, 0),
    (0, 90, 0.0, 20, 0.0, 70, 0.0, 0), (0, 120, 0.0, 15, 0.1, 33, 0.0, 0), (0, 2, 0.0, 33, 0.0, 1, 0.0, 0),
    # the article of a page that marks it, short paragraphs and headings included
    (3, 9, 0.0, 7, 0.0, 60, 0.0, 1), (3, 60, 0.0, 9, 0.0, 45, 0.0, 1), (3, 1, 0.0, 45, 0.0, 2, 0.0, 1),
    (3, 2, 0.0, 1, 0.0, 70, 0.0, 1), (3, 35, 0.2, 70, 0.0, 20, 0.0, 1), (3, 5, 1.0, 35, 0.0, 50, 0.0, 1),
    (3, 50, 0.0, 5, 1.0, 14, 0.0, 1), (3, 14, 0.4, 50, 0.0, 10, 0.0, 1), (3, 1, 1.0, 14, 0.4, 4, 0.0, 1),
    (3, 3, 0.0, 0, 0.0, 0, 0.0, 1), (3, 110, 0.1, 3, 0.0, 1, 1.0, 1), (3, 18, 0.0, 25, 0.0, 12, 0.0, 1),
    # what else such a page has
    (1, 3, 0.0, 1, 1.0, 9, 0.0, 0), (1, 1, 1.0, 2, 1.0, 2, 1.0, 0), (1, 25, 0.0, 40, 0.0, 0, 0.0, 0),
    (1, 12, 0.1, 0, 0.0, 6, 0.5, 0), (1, 60, 0.0, 33, 0.0, 1, 1.0, 0), (1, 8, 0.9, 60, 0.0, 5, 1.0, 0),
    (1, 40, 0.3, 5, 1.0, 0, 0.0, 0), (1, 5, 0.0, 0, 0.0, 30, 0.0, 0), (1, 33, 0.0, 12, 0.0, 60, 0.0, 0),
    # pages that mark nothing: running text, short paragraphs and headings beside long ones
    (2, 45, 0.0, 8, 0.0, 60, 0.0, 1), (2, 60, 0.1, 45, 0.0, 3, 0.9, 1), (2, 38, 0.2, 1, 1.0, 2, 1.0, 1),
    (2, 12, 0.0, 38, 0.2, 5, 0.5, 1), (2, 25, 0.0, 1, 1.0, 2, 1.0, 1), (2, 80, 0.3, 6, 0.0, 3, 1.0, 1),
    (2, 20, 0.1, 22, 0.0, 1, 0.0, 1), (2, 14, 0.0, 0, 0.0, 0, 0.0, 1), (2, 33, 0.1, 2, 1.0, 60, 0.0, 1),
    (2, 11, 0.0, 4, 0.5, 40, 0.0, 1), (2, 9, 0.0, 40, 0.0, 44, 0.0, 1), (2, 5, 0.0, 30, 0.0, 28, 0.0, 1),
    (2, 3, 0.0, 26, 0.0, 40, 0.0, 1), (2, 4, 0.0, 55, 0.0, 31, 0.0, 1), (2, 6, 0.0, 2, 1.0, 50, 0.0, 1),
    (2, 3, 0.0, 1, 1.0, 45, 0.0, 1), (2, 1, 0.0, 33, 0.0, 48, 0.0, 1), (2, 2, 0.0, 5, 0.3, 70, 0.0, 1),
    # pages that mark nothing: the rest
    (2, 1, 1.0, 0, 0.0, 1, 1.0, 0), (2, 2, 1.0, 1, 1.0, 2, 1.0, 0), (2, 6, 0.8, 2, 1.0, 60, 0.0, 0),
    (2, 15, 0.7, 3, 1.0, 44, 0.0, 0), (2, 30, 0.9, 60, 0.0, 25, 0.8, 0), (2, 12, 0.6, 38, 0.0, 50, 0.0, 0),
    (2, 40, 0.5, 20, 0.0, 12, 0.1, 0), (2, 3, 0.0, 2, 1.0, 4, 1.0, 0), (2, 4, 0.3, 5, 0.5, 0, 0.0, 0),
    (2, 7, 0.4, 60, 0.0, 2, 1.0, 0), (2, 2, 0.0, 3, 1.0, 1, 1.0, 0), (2, 5, 0.6, 70, 0.0, 6, 0.7, 0),
    (2, 4, 0.0, 3, 0.4, 2, 0.0, 0), (2, 3, 0.0, 4, 0.0, 3, 0.0, 0), (2, 5, 0.0, 45, 0.0, 1, 1.0, 0),
    (2, 6, 0.0, 60, 0.0, 0, 0.0, 0), (2, 2, 0.5, 40, 0.0, 50, 0.0, 0), (2, 8, 0.5, 35, 0.0, 30, 0.0, 0),
]


@dataclass
class Block:
    text: str
    boiler: int
    article: int
    words: int
    link_density: float


@dataclass
class _Open:
    """Open elements, and how many of them mark a menu or the article."""

    stack: list[tuple[str, int, int]] = field(default_factory=list)
    names: dict[str, int] = field(default_factory=dict)
    boiler: int = 0
    article: int = 0

    def push(self, name: str, boiler: int, article: int) -> None:
        self.stack.append((name, boiler, article))
        self.names[name] = self.names.get(name, 0) + 1
        self.boiler += boiler
        self.article += article

    def close(self, name: str, upto: frozenset[str] = frozenset()) -> None:
        """Close the innermost ``name`` and what is open within it, unless one of ``upto`` is nearer."""
        if not self.names.get(name):
            return
        if upto:
            for open_name, _, _ in reversed(self.stack):
                if open_name == name:
                    break
                if open_name in upto:
                    return
        while True:
            last, boiler, article = self.stack.pop()
            self.names[last] -= 1
            self.boiler -= boiler
            self.article -= article
            if last == name:
                return


_LISTS = frozenset(["ul", "ol", "dl", "table", "tbody", "select"])


def _mark(name: str, attributes: str, within_article: bool) -> tuple[int, int]:
    """Whether an element opens boilerplate, and whether it opens the article."""
    if name in CONTENT_TAGS:
        return 0, 1
    boiler = name in BOILER_TAGS or (name == "header" and not within_article)
    if not boiler and "=" in attributes:
        words: set[str] = set()
        for m in _NAMES.finditer(attributes):
            words.update(_PARTS.findall((m[1] or m[2] or m[3] or "").lower()))
        boiler = bool(words & STRONG) or bool(words & SOFT and not words & CONTENT and not within_article)
    return int(boiler), 0


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order; comments, scripts, styles and form controls have none.

    A form control or drawing that is never closed is read as text, so that it cannot swallow the rest of the page.
    """
    found: list[Block] = []
    open_ = _Open()
    parts: list[str] = []
    linked = 0
    links = 0

    def end() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", "".join(parts)).strip()
            if text:
                words = text.count(" ") + 1
                found.append(Block(text, int(open_.boiler > 0), int(open_.article > 0), words, min(1.0, linked / words)))
            parts.clear()
        linked = 0

    ends: dict[str, re.Pattern | None] = {}
    at, size = 0, len(page)
    while at < size:
        begin = page.find("<", at)
        m = _TAG.match(page, begin) if begin >= 0 else None
        # Without a tag there the text goes on, a less-than sign included.
        stop = size if begin < 0 else begin if m else begin + 1
        if stop > at:
            text = html.unescape(page[at:stop])  # a reference ends where a tag begins
            parts.append(text)
            if links:
                linked += len(text.split())
        at = stop
        if m is None:
            continue
        at = m.end()
        name = (m[1] or "").lower()
        if not name:
            continue
        if m[0].startswith("</"):
            if name == "a":
                links = 0
            if name not in INLINE:
                end()
            open_.close(name)
            continue
        if name in RAW:
            if name not in ends:
                ends[name] = re.compile(f"<{'/?' if name in UNNESTED else '/'}{name}\\b[^>]*>?", re.I)
            closing = ends[name].search(page, at) if ends[name] else None
            if closing and closing[0].startswith("</") or name in ENDLESS:
                at = closing.end() if closing else size
                continue
            if not closing:
                ends[name] = None  # nor will a later one find an end
        if name == "a":
            links = 1
        if name not in INLINE:
            end()
            if open_.names.get("p"):
                open_.close("p")
            if name in _SIBLINGS:
                open_.close(name, _LISTS)
        if name not in VOID and not m[2].endswith("/"):
            open_.push(name, *_mark(name, m[2], open_.article > 0))
    end()
    return found


def features_of(blocks: list[Block]) -> np.ndarray:
    outside = 1 if any(b.article for b in blocks) else 2
    rows = np.zeros((len(blocks), len(FEATURES)))
    for i, b in enumerate(blocks):
        rows[i, :3] = 0 if b.boiler else 3 if b.article else outside, b.words, b.link_density
    rows[1:, 3:5] = rows[:-1, 1:3]
    rows[:-1, 5:7] = rows[1:, 1:3]
    return rows


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 6) -> tuple | int:
    """A tree by Gini impurity: ``(feature, bound, at most, above)`` or the label; ties go to the first feature."""
    if depth == 0 or labels.min() == labels.max():
        return int(2 * labels.sum() > len(labels))
    best = None
    for k in range(rows.shape[1]):
        values = np.unique(rows[:, k])
        for bound in (values[1:] + values[:-1]) / 2:
            low = rows[:, k] <= bound
            score = sum(part.mean() * (1 - part.mean()) * len(part) for part in (labels[low], labels[~low]))
            if best is None or score < best[0] - 1e-12:
                best = score, k, float(bound), low
    if best is None:
        return int(2 * labels.sum() > len(labels))
    _, k, bound, low = best
    return k, bound, grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1)


def decide(tree: tuple | int, rows: np.ndarray) -> np.ndarray:
    if isinstance(tree, int):
        return np.full(len(rows), tree, bool)
    k, bound, low, high = tree
    return np.where(rows[:, k] <= bound, decide(low, rows), decide(high, rows))


def _tree() -> tuple | int:
    table = np.array(LABELLED, float)
    return grow(table[:, :-1], table[:, -1])


def main_text(page: str | None, tree: tuple | int) -> str:
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    return " ".join(b.text for b, keep in zip(blocks, decide(tree, features_of(blocks))) if keep)


def _extracted(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = _tree()
        for batch in pieces(batches, "html"):
            texts = [main_text(x.as_py(), tree) for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(texts, pa.string())],
                                             [*names, "text"])

    return run


def extract(pages: DataFrame, column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` and ``text``, the main text of each whole page.

    White space inside a block becomes one space, and blocks are joined by one space. NULL and
    empty pages, and pages without main text, give the empty text. Repeated rows stay; other
    columns are ignored; an empty table gives an empty result.
    """
    names = [f"c{i}" for i in range(len(keep))]
    rows = pages.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)), F.col(f"`{column}`").alias("html"))
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]] + ["text string"])
    out = rows.mapInArrow(_extracted(names), schema)
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), "text")
