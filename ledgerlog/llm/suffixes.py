"""Benchmark decontamination: suffix arrays of the training text, searched with every test suffix.

Each shard of documents (a few megabytes of a partition) becomes an array of word numbers and a
suffix array over it. Every suffix of a test item that holds a whole window (of a shorter item:
the item) is looked up by binary search, word by word; an occurrence of a whole window is a hit,
and the match is followed to its longest extent. Matches shorter than the window are not reported.
The array holds the suffixes a search can reach: those that begin with as many words of the test
vocabulary as the shortest window has. Test items are sent in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .shared import pieces

WINDOW = 13
SHARD_BYTES = 4 << 20
ITEM_BYTES = 8 << 20


class Queries:
    """The test suffixes of one block of items."""

    def __init__(self, keys: list[int], texts: list[str], window: int):
        found = W.split(pa.array(texts, pa.string()), W.ALPHANUMERIC)
        values = W.hashes(found)
        self.vocabulary = np.unique(values)
        self.words = np.searchsorted(self.vocabulary, values).astype(np.int64) + 1
        begins, ends, items = [], [], []
        for key, begin, end in zip(keys, found.offsets[:-1].tolist(), found.offsets[1:].tolist()):
            width = min(window, end - begin)
            for at in range(begin, end - width + 1) if width else ():
                begins.append(at)
                ends.append(end)
                items.append(key)
        self.begins, self.ends = np.array(begins, np.int64), np.array(ends, np.int64)
        self.items = np.array(items, np.int64)
        self.widths = np.minimum(window, self.ends - self.begins)
        # A short item has one window, so its suffix is as long as the item.
        self.shortest = int(self.widths.min()) if len(items) else 0
        self.depth = int((self.ends - self.begins).max()) if len(items) else 0
        bits = max(1, int(len(self.vocabulary)).bit_length())
        self.pack, self.bits = max(1, 62 // bits), bits


def suffix_array(ids: np.ndarray, at: np.ndarray, depth: int, pack: int, bits: int) -> np.ndarray:
    """The positions ``at`` in the order of the ``depth`` words that start there.

    ``pack`` words make one sort key; after the first sort only positions still tied are sorted on.
    """
    def key(where: np.ndarray, begin: int) -> np.ndarray:
        value = np.zeros(len(where), np.int64)
        for k in range(begin, begin + pack):
            value = (value << bits) | ids[np.minimum(where + k, len(ids) - 1)]
        return value

    keys = key(at, 0)
    sort = np.argsort(keys, kind="stable")
    order, keys = at[sort], keys[sort]
    tied = np.arange(len(order))
    group = np.zeros(len(order), np.int64)
    done = pack
    while len(tied):
        fresh = np.ones(len(tied), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (keys[1:] != keys[:-1])
        group = np.cumsum(fresh)
        alone = fresh & np.append(fresh[1:], True)
        tied, group = tied[~alone], group[~alone]
        if done >= depth or not len(tied):
            break
        sub = order[tied]
        keys = key(sub, done)
        sort = np.lexsort((keys, group))
        order[tied], keys, group = sub[sort], keys[sort], group[sort]
        done += pack
    return order


def occurrences(ids: np.ndarray, order: np.ndarray, q: Queries) -> tuple[np.ndarray, np.ndarray]:
    """(query, position) of every place where a whole window of a query stands."""
    low = np.zeros(len(q.begins), np.int64)
    high = np.full(len(q.begins), len(order), np.int64)
    for step in range(int(q.widths.max())):
        live = np.flatnonzero((low < high) & (q.widths > step))
        if not len(live):
            break
        want = q.words[q.begins[live] + step]
        edges = []
        for side in (0, 1):
            a, b = low[live].copy(), high[live].copy()
            while (open_ := a < b).any():
                mid = (a + b) >> 1
                seen = ids[order[np.minimum(mid, len(order) - 1)] + step]
                right = open_ & ((seen < want) | ((seen == want) & bool(side)))
                a = np.where(right, mid + 1, a)
                b = np.where(open_ & ~right, mid, b)
            edges.append(a)
        low[live], high[live] = edges
    count = high - low
    count[count < 0] = 0
    query = np.repeat(np.arange(len(count)), count)
    head = np.cumsum(count) - count
    return query, order[low[query] + np.arange(len(query)) - head[query]]


def search(texts: pa.Array, q: Queries) -> list[dict]:
    """Words, hit intervals, items and the longest match of each text."""
    found = W.split(texts, W.ALPHANUMERIC)
    n_words = np.diff(found.offsets)
    rows = [{"n_words": int(n), "hits": [], "items": [], "longest": 0, "longest_at": None, "longest_item": None}
            for n in n_words]
    if not len(q.begins) or not len(found.starts):
        return rows
    values = W.hashes(found)
    place = np.minimum(np.searchsorted(q.vocabulary, values), len(q.vocabulary) - 1)
    numbers = np.where(q.vocabulary[place] == values, place + 1, 0)
    # One 0 after each text, and room to look ahead.
    text_of = np.repeat(np.arange(len(n_words)), n_words)
    ids = np.zeros(len(numbers) + len(n_words) + q.depth + 1, np.int64)
    ids[np.arange(len(numbers)) + text_of] = numbers
    breaks = np.flatnonzero(ids == 0)
    known = np.flatnonzero(ids)
    at = known[breaks[np.searchsorted(breaks, known)] - known >= q.shortest]
    if not len(at):
        return rows
    order = suffix_array(ids, at, q.depth, q.pack, q.bits)
    query, position = occurrences(ids, order, q)
    if not len(query):
        return rows
    length = q.widths[query]
    grow = np.arange(len(query))
    while len(grow):
        after = q.begins[query[grow]] + length[grow]
        more = after < q.ends[query[grow]]
        grow, after = grow[more], after[more]
        grow = grow[ids[position[grow] + length[grow]] == q.words[after]]
        length[grow] += 1
    heads = found.offsets[:-1] + np.arange(len(n_words))
    doc = np.searchsorted(heads, position, "right") - 1
    begin = position - heads[doc]
    for d in np.unique(doc).tolist():
        own = np.flatnonzero(doc == d)
        row = rows[d]
        row["hits"] = united(begin[own], begin[own] + q.widths[query[own]])
        row["items"] = np.unique(q.items[query[own]]).tolist()
        best = own[np.lexsort((begin[own], -length[own]))[0]]
        row |= {"longest": int(length[best]), "longest_at": int(begin[best]),
                "longest_item": int(q.items[query[best]])}
    return rows


def united(begins, ends) -> list[list[int]]:
    """Disjoint sorted intervals that cover the same words."""
    out: list[list[int]] = []
    for a, b in sorted(set(zip(map(int, begins), map(int, ends)))):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


_FOUND = ("n_words bigint, hits array<array<bigint>>, items array<bigint>, longest bigint, longest_at bigint, "
          "longest_item bigint")
_TYPES = pa.schema([("id", pa.int64()), ("digest", pa.int64()), ("n_words", pa.int64()),
                    ("hits", pa.list_(pa.list_(pa.int64()))), ("items", pa.list_(pa.int64())),
                    ("longest", pa.int64()), ("longest_at", pa.int64()), ("longest_item", pa.int64())])


def _searched(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = Queries(*block.value)
        for batch in pieces(batches, "text", SHARD_BYTES):
            rows = search(batch.column("text"), q)
            for row, key, digest in zip(rows, batch.column("id").to_pylist(), batch.column("digest").to_pylist()):
                row |= {"id": key, "digest": digest}
            yield pa.RecordBatch.from_pylist(rows, _TYPES)

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document from its rows of several item blocks."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            parts = row.pop("parts")
            spans = [s for p in parts for s in p["hits"]]
            best = max(parts, key=lambda p: (p["longest"], -(p["longest_at"] or 0)))
            rows.append(row | {
                "hits": united([a for a, _ in spans], [b for _, b in spans]),
                "items": sorted({i for p in parts for i in p["items"]}),
                **{k: best[k] for k in ("longest", "longest_at", "longest_item")}})
        yield pa.RecordBatch.from_pylist(rows, _TYPES)


def _item_blocks(items: DataFrame, key: str, text: str, limit: int) -> Iterator[tuple[list[int], list[str]]]:
    keys: list[int] = []
    texts: list[str] = []
    size = 0
    rows = items.select(F.col(f"`{key}`").cast("bigint").alias("k"), F.col(f"`{text}`").alias("t"))
    for row in rows.where("k IS NOT NULL AND t IS NOT NULL").toLocalIterator():
        if texts and size + len(row["t"]) > limit:
            yield keys, texts
            keys, texts, size = [], [], 0
        keys.append(row["k"])
        texts.append(row["t"])
        size += len(row["t"])
    yield keys, texts


def overlaps(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
             item_text: str = "text", window: int = WINDOW, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """One row per document: ``key``, ``n_words``, ``n_hit``, ``items``, ``hits``, ``longest``, ``longest_at``,
    ``longest_item``, ``contaminated``.

    ``hits`` are disjoint [begin, end) word intervals that test windows cover; ``n_hit`` is their
    length; ``longest`` is the longest verbatim match in words among those of a whole window or a
    whole shorter item (0 without one), ``longest_at`` where it starts. A
    document is contaminated when 20 * n_hit >= n_words and n_hit > 0.

    NULL texts and texts without words have no words, hits or items, and items without words or
    with a NULL key match nothing. Repeated documents and items change nothing in the other rows;
    repeated document rows appear as often as they came. Other columns are ignored; an empty
    table of documents gives an empty result, an empty one of items gives no hits. Both keys
    must be integers.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.xxhash64(f"`{text}`").alias("digest"),
                       F.col(f"`{text}`").alias("text"))
    passes = [
        rows.mapInArrow(_searched(spark.sparkContext.broadcast((keys, texts, window))),
                        f"id bigint, digest bigint, {_FOUND}")
        for keys, texts in _item_blocks(items, item_key, item_text, item_bytes)]
    found = passes[0]
    if len(passes) > 1:
        for other in passes[1:]:
            found = found.unionByName(other)
        fields = ("hits", "items", "longest", "longest_at", "longest_item")
        found = (found.groupBy("id", "digest", "n_words")
                 .agg(F.collect_list(F.struct(*fields)).alias("parts"), F.count("*").alias("n"))
                 .withColumn("copy", F.explode(F.sequence(F.lit(1), F.expr(f"int(n div {len(passes)})"))))
                 .drop("n", "copy").mapInArrow(_merged, f"id bigint, digest bigint, {_FOUND}"))
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, s: n + s[1] - s[0])
    return found.withColumn("n_hit", n_hit).select(
        F.col("id").alias(key), "n_words", "n_hit", "items", "hits", "longest", "longest_at", "longest_item",
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))
