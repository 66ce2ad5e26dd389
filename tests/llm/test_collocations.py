"""Collocations against plain counting, tries against dictionaries, on awkward texts."""

import random
import re
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from llm_common import importable  # noqa: F401

from ledgerlog.llm import collocations, tries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least=30, top=2000):
    total, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            f.update((lang, *words[i:i + k]) for k in (1, 2, 3, 4) for i in range(len(words) - k + 1))
    f = {g: n for g, n in f.items() if n >= least}
    longest = Counter()
    for (lang, *g), n in f.items():
        for m in range(2, len(g)):
            for i in range(len(g) - m + 1):
                longest[lang, *g[i:i + m]] = max(longest[lang, *g[i:i + m]], n)
    found = {}
    for (lang, *g), a in f.items():
        if len(g) > 1 and 100 * longest[lang, *g] < 80 * a:
            cuts = [(f[lang, *g[:k]], f[lang, *g[k:]], k) for k in range(1, len(g))]
            score, _, l, r = min((2_000_000 * a // (l + r), k, l, r) for l, r, k in cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), l, r))
    return sorted((lang, i + 1, g.decode(), -a, l, r, total[lang], -s) for lang, rows in found.items()
                  for i, (s, a, g, l, r) in enumerate(sorted(rows)[:top]))


def table(spark, rows):
    return spark.createDataFrame([(t, g, 1, "x", None) for t, g in rows],
                                 "text string, lang string, n int, phrase string, hash int").repartition(3)


def found(spark, rows, **kw):
    return sorted(tuple(r) for r in collocations.collocations(table(spark, rows), **kw).collect())


def texts(n, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(25)] + ["É", "é", "NEW", "york", "日本", "a\xa0b", "x\x00y"]
    phrases = [" ".join(rng.choices(vocabulary, k=rng.randint(2, 6))) for _ in range(12)]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 30)):
            parts.append(rng.choice(phrases) if rng.random() < 0.4 else rng.choice(vocabulary))
            parts.append(rng.choice([" ", " ", " ", " ", "\t", "  ", ". ", ",", "\n", "!?", "\x0b"]))
        rows.append(("".join(parts), rng.choice(["en", "en", "en", "de", None, "und", ""])))
    return rows


@pytest.mark.parametrize("least", [30, 3])
def test_matches_plain_counting(spark, monkeypatch, least):
    monkeypatch.setattr(collocations, "TRIE_PHRASES", 40)
    monkeypatch.setattr(collocations, "BROADCAST_BYTES", 20_000)
    rows = texts(400, least) + [(None, "en"), ("", "en"), (" . ", None), ("one", "fr"), ("a a " * 3000, "es"), ("NEW YORK " * 50, "en")]
    want = plain(rows, least)
    assert len(want) > 50 and found(spark, rows, least=least) == want


def test_limit_and_shares(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SALT_ROWS", 10)
    rows = texts(300, 5)
    assert found(spark, rows, least=5, top=7) == plain(rows, 5, 7)


def test_hot_language_and_long_text(spark):
    rows = [("hot phrase here. " * 4000, "en")] + [("hot phrase here and there", "en")] * 200 + [("b c", "de")] * 100
    assert found(spark, rows) == plain(rows)


def test_shared_hashes_start_again(spark, monkeypatch):
    """With multipliers that do not tell bytes apart, anagrams collide; the next seed must take over."""
    real = collocations._multipliers
    monkeypatch.setattr(collocations, "_multipliers", lambda seed: real(seed) if seed else np.full(256, 3, np.uint64))
    rows = [("ab cd", "en")] * 40 + [("ba cd", "en")] * 40
    assert found(spark, rows) == plain(rows)


def test_scores_beyond_64_bits(spark):
    huge = 2**61
    phrases = spark.createDataFrame([("en", 2, 1, 2, 0, 0, huge)], "lang string, n int, w1 bigint, w2 bigint, w3 bigint, w4 bigint, f bigint")
    frequent = spark.createDataFrame([("en", 1, huge + 1), ("en", 2, huge + 5)], "lang string, last bigint, f bigint")
    row = collocations._scored(phrases, frequent, 2_000_000).first()
    assert (row.l, row.r, row.score) == (huge + 1, huge + 5, 2_000_000 * huge // (2 * huge + 6))


def test_empty(spark):
    assert found(spark, []) == [] == found(spark, [("a b", "en")]) == found(spark, [(None, None)])
    assert collocations.collocations(table(spark, [])).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("n,symbols", [(0, 5), (1, 1), (50, 3), (3000, 40), (3000, 2000)])
def test_trie_holds_exactly_its_phrases(n, symbols):
    rng = np.random.default_rng(n + symbols)
    values = np.sort(rng.integers(-2**62, 2**62, symbols))
    lengths = rng.integers(2, 5, n)
    rows = {tuple(values[rng.integers(0, symbols, k)].tolist()) for k in lengths}
    if n == 3000:
        rows |= {(int(values[0]), int(v)) for v in values}
    rows = sorted(rows)
    lengths = np.array([len(r) for r in rows], int)
    padded = np.array([list(r) + [0] * (4 - len(r)) for r in rows], np.int64).reshape(len(rows), 4)
    trie, states = tries.build(padded, lengths)
    text = rng.choice(np.append(values, [1, 2]), 4000)
    symbol = trie.symbols(text)
    reached = np.bincount(np.concatenate(trie.walk(symbol, 4)), minlength=len(trie.base))
    want = Counter(tuple(text[i:i + k].tolist()) for k in (2, 3, 4) for i in range(len(text) - k + 1))
    assert len(set(states.tolist())) == len(rows)
    assert [int(reached[s]) for s in states] == [want[r] for r in rows]


def stretch(words, codes):
    return pa.RecordBatch.from_pydict({"lang": ["en"], "hashes": [words.view(np.int64)], "codes": [codes.astype(np.int32).tobytes()]})


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_nominations_across_blocks(monkeypatch, levels):
    """Blocks, sums and batches that end anywhere lose no phrase and count none twice."""
    for name, size in (("POSITIONS", 7), ("NOMINATIONS", 20), ("BATCH_ROWS", 5)):
        monkeypatch.setattr(collocations, name, size)
    rng = np.random.default_rng(levels)
    words = rng.integers(0, 2**63, 6, dtype=np.uint64)
    filters = [SimpleNamespace(value=rng.integers(0, 2**63, 1 << (collocations.BITS - 6), dtype=np.uint64) | np.uint64(2**63) |
                               rng.integers(0, 2**63, 1 << (collocations.BITS - 6), dtype=np.uint64)) for _ in range(levels)]
    want, texts = Counter(), [rng.choice(7, size, p=[0.1] + [0.15] * 6) for size in (1, 6, 7, 8, 9, 50, 301)]
    for codes in texts:
        chains = [collocations._root("en")] * len(codes)
        good = np.ones(len(codes), bool)
        for level, bits in enumerate(filters):
            chains = [collocations._chained(np.array([chains[p]]), words[codes[p + level:p + level + 1] - 1])[0]
                      if good[p] and p + level < len(codes) and codes[p + level] else None for p in range(len(codes))]
            passed = [c is not None and bool(collocations._passes(bits.value, np.array([c]))[0]) for c in chains]
            good = np.array([passed[p] and p + 1 < len(codes) and passed[p + 1] for p in range(len(codes))], bool)
        want.update((int(chains[p]), int(words[codes[p + levels] - 1])) for p in np.flatnonzero(good))
    found, batches = Counter(), list(collocations._nominated(filters)(stretch(words, codes) for codes in texts))
    for batch in batches:
        prefix, last = (batch.column(c).to_numpy().view(np.uint64).tolist() for c in ("prefix", "last"))
        for *phrase, n in zip(prefix, last, batch.column("n").to_pylist()):
            found[tuple(phrase)] += n
    assert max(b.num_rows for b in batches) <= 5 and len(want) > 4 and found == want


def test_nominations_take_bounded_memory():
    """What a task holds must not grow with its stretches: they are summed early, and leave in small batches."""
    rng = np.random.default_rng(8)
    words = rng.integers(0, 2**63, 40_000, dtype=np.uint64)
    every = SimpleNamespace(value=np.full(1 << (collocations.BITS - 6), 2**64 - 1, np.uint64))
    given = [stretch(words, rng.integers(1, len(words) + 1, 2_000_000)) for _ in range(2)]
    total = largest = 0
    tracemalloc.start()
    try:
        for batch in collocations._nominated([every])(iter(given)):
            total, largest = total + pc.sum(batch.column("n")).as_py(), max(largest, batch.nbytes)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert total == 2 * 1_999_999 and largest <= 2 << 20 and peak < 200_000_000
