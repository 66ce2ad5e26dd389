"""Phrases whose words keep together, counted with double-array tries.

Each text becomes a sequence of places in the vocabulary of its stretch of texts, written once. Level by level,
tasks nominate the phrases whose parts without the first and without the last word may be frequent,
by a filter of fixed size that never denies a frequent one; nominations that add up to the minimum are the
candidates. These are compiled into tries of bounded size, in tasks; the tries are broadcast in bounded
groups, and tasks advance the states of all text positions through them together, level by level, and count the states reached. The
sums over all tasks are the counts of the phrases.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import pieces, removed, scratch, written
from .tries import Trie, build
from .words import Words, hashes, mix, split, utf8, word_class

STRETCH_BYTES = 8 << 20
BITS = 26
POSITIONS = 1 << 17
NOMINATIONS = 1 << 20
BATCH_ROWS = 1 << 16
TRIE_PHRASES = 250_000
BROADCAST_BYTES = 64 << 20
SALT_ROWS = 20_000
SLICE = 4096

_BREAKS = b".,;:!?\n\x0b\x0c\r"
#: Words ``[^\x20\x09]+`` of pieces; NUL is a word byte, so it becomes 255, which UTF-8 lacks.
_CLASS = word_class(b" \t" + _BREAKS)
_CLASS[0] = 255
_HARD = np.isin(np.arange(256), list(_BREAKS))

_WORDS = [f"w{i}" for i in range(1, 5)]


def _multipliers(seed: int) -> np.ndarray:
    return np.random.default_rng([20240911, seed]).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _tokens(seed: int, limit: int):
    """Rows of ``limit`` bytes of texts of a language: their vocabulary with counts, and the texts as places in it, from 1;
    0 stands between pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        random = _multipliers(seed)
        for batch in batches:
            for lang in pc.unique(batch.column("lang")):
                for part in pieces([batch.filter(pc.equal(batch.column("lang"), lang))], "text", limit):
                    words = split(part.column("text"), _CLASS)
                    if not len(words.starts):
                        continue
                    at = _apart(words, part.column("text"))
                    found, first, places, counts = np.unique(
                        hashes(words, random), return_index=True, return_inverse=True, return_counts=True)
                    codes = np.zeros(at[-1] + 1, np.int32)
                    codes[at] = places + 1
                    del at
                    other = _others(words, first, places)
                    found, counts = np.append(found, found[places[other]]), np.append(counts, np.zeros_like(other))
                    first = np.append(first, other)
                    text = words.data.tobytes().replace(b"\xff", b"\0")
                    spans = zip(words.starts[first].tolist(), words.ends[first].tolist())
                    yield pa.RecordBatch.from_pydict(
                        {"lang": [lang.as_py()], "words": [[text[a:b] for a, b in spans]],
                         "hashes": [found.view(np.int64)], "counts": [counts], "codes": [codes.tobytes()]},
                        pa.schema([("lang", pa.string()), ("words", pa.list_(pa.binary())), ("hashes", pa.list_(pa.int64())),
                                   ("counts", pa.list_(pa.int64())), ("codes", pa.binary())]))

    return run


def _apart(words: Words, texts: pa.Array) -> np.ndarray:
    """The place of each word where one stays free between pieces."""
    breaks = np.flatnonzero(_HARD[utf8(texts)[0]])
    hard = np.searchsorted(breaks, words.starts)
    after = np.append(False, hard[1:] != hard[:-1])
    heads = words.offsets[:-1]
    after[heads[(heads > 0) & (heads < len(after))]] = True
    found = np.cumsum(after)
    found += np.arange(len(after))
    return found


def _others(words: Words, first: np.ndarray, places: np.ndarray, block: int = 1 << 17) -> np.ndarray:
    """Words that differ from the first one of their hash; they are listed besides it, so that the shared hash is seen."""
    found = []
    for begin in range(0, len(places), block):
        at = slice(begin, begin + block)
        same = first[places[at]]
        sizes = words.ends[at] - words.starts[at]
        wrong = sizes != words.ends[same] - words.starts[same]
        owner = np.repeat(np.arange(len(sizes), dtype=np.int32), np.where(wrong, 0, sizes))
        left = words.starts[at][owner] + np.arange(len(owner)) - (np.cumsum(np.where(wrong, 0, sizes)) - sizes)[owner]
        right = left + (words.starts[same] - words.starts[at])[owner]
        wrong[owner[words.data[left] != words.data[right]]] = True
        found.append(begin + np.flatnonzero(wrong))
    return np.concatenate(found)


def _root(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little"))


def _chained(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A hash of each phrase from that of its beginning and its last word."""
    found = prefix * np.uint64(0xD6E8FEB86659FD93)
    found ^= found >> np.uint64(31)
    found += word
    return mix(found)


def _listed(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    for row in range(batch.num_rows):
        yield (batch.column("lang")[row].as_py(), batch.column("hashes")[row].values.to_numpy().view(np.uint64),
               np.frombuffer(batch.column("codes")[row].as_py(), np.int32))


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each phrase; of single words from their language."""
    for batch in batches:
        last = batch.column("last").to_numpy().view(np.uint64)
        if "lang" in batch.schema.names:
            prefix = np.array([_root(v) for v in batch.column("lang").to_pylist()], np.uint64)
        else:
            prefix = batch.column("prefix").to_numpy().view(np.uint64)
        yield batch.append_column("code", pa.array(_chained(prefix, last).view(np.int64)))


def _filter(codes: DataFrame) -> np.ndarray:
    """One bit for each of the lowest ``BITS`` bits of a code: at most 2^``BITS`` / 64 numbers reach the driver."""
    rows = codes.select(F.expr(f"shiftright(code & {(1 << BITS) - 1}L, 6)").alias("at"),
                        F.expr("shiftleft(1L, CAST(code & 63 AS INT))").alias("bit"))
    held = rows.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(1 << (BITS - 6), np.uint64)
    bits[held.column("at").to_numpy()] = held.column("bits").to_numpy().view(np.uint64)
    return bits


def _passes(bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
    low = codes & np.uint64((1 << BITS) - 1)
    return (bits[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) != 0


def _nominated(filters: list):
    """Phrases of one word more than there are filters, as the hash of all but the last word, the last word, and a count.

    Positions come in blocks, nominations are summed and leave in batches, so what a task holds besides its texts is bounded.
    """
    def summed(prefixes: list[np.ndarray], lasts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        prefix, last = np.concatenate(prefixes), np.concatenate(lasts)
        prefixes.clear()
        lasts.clear()
        code = _chained(prefix, last)
        order = np.argsort(code)
        code = code[order]
        first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        del code
        n, order = np.diff(first, append=len(order)), order[first]
        prefix, last = prefix[order].view(np.int64), last[order].view(np.int64)
        del first, order
        for begin in range(0, len(n), BATCH_ROWS):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[begin:begin + BATCH_ROWS]) for c in (prefix, last, n)], ["prefix", "last", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [f.value for f in filters]
        prefixes, lasts, held = [], [], 0
        for batch in batches:
            for lang, words, codes in _listed(batch):
                single = _chained(np.full(len(words), _root(lang)), words)
                known = np.append(False, _passes(bits[0], single))
                for begin in range(0, len(codes), POSITIONS):
                    # The block and the words that phrases begun in it may still reach.
                    block = codes[begin:begin + POSITIONS + len(bits)]
                    at = np.flatnonzero(known[block])
                    chain = single[block[at] - 1]
                    inside = np.zeros(len(block) + 1, bool)
                    for level in range(1, len(bits) + 1):
                        inside[:] = False
                        inside[at] = True
                        both = inside[at + 1]
                        at, chain = at[both], chain[both]
                        last = words[block[at + level] - 1]
                        if level < len(bits):
                            chain = _chained(chain, last)
                            frequent = _passes(bits[level], chain)
                            at, chain = at[frequent], chain[frequent]
                    own = at < POSITIONS
                    prefixes.append(chain[own])
                    lasts.append(last[own])
                    held += len(prefixes[-1])
                    if held >= NOMINATIONS:
                        yield from summed(prefixes, lasts)
                        held = 0
        if held:
            yield from summed(prefixes, lasts)

    return run


def _compiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row with the trie of each shard, and a row for each of its phrases with the state it ends in."""
    names = ["lang", "shard", "vocabulary", "base", "check", "state", "n", *_WORDS]

    def trie(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        phrases = np.stack([rows.column(w).to_numpy() for w in _WORDS], axis=1)
        made, states = build(phrases, rows.column("n").to_numpy())
        n = len(states)
        yield pa.RecordBatch.from_arrays(
            [rows.column("lang").slice(0, 1), rows.column("shard").slice(0, 1),
             *(pa.array([a.tobytes()]) for a in (made.vocabulary, made.base, made.check)),
             *(pa.nulls(1, pa.int32()) for _ in range(2)), *(pa.nulls(1, pa.int64()) for _ in _WORDS)], names)
        yield pa.RecordBatch.from_arrays(
            [rows.column("lang"), rows.column("shard"), *(pa.nulls(n, pa.binary()) for _ in range(3)),
             pa.array(states.astype(np.int32)), rows.column("n"), *(rows.column(w) for w in _WORDS)], names)

    now, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        shards = batch.column("shard").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if shards[a] != now and parts:
                yield from trie(parts)
                parts = []
            now = shards[a]
            parts.append(batch.slice(a, b - a))
    if parts:
        yield from trie(parts)


def _counted(group):
    """How often each state of the tries is reached, from all positions of the texts of their languages.

    Counts leave a task packed, in slices of ``SLICE`` states.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries = [(shard, lang, Trie(*(np.frombuffer(part, kind) for part, kind in zip(parts, (np.int64, np.int32, np.int32)))))
                 for shard, lang, *parts in group.value]
        totals = [np.zeros(len(trie.base), np.int64) for _, _, trie in tries]
        for batch in batches:
            for lang, words, codes in _listed(batch):
                for i, (_, own, trie) in enumerate(tries):
                    if own == lang:
                        symbols = np.append(np.int32(0), trie.symbols(words.view(np.int64)))[codes]
                        reached = np.concatenate(trie.walk(symbols, len(_WORDS))[1:])
                        totals[i] += np.bincount(reached, minlength=len(trie.base))
        for (shard, _, _), total in zip(tries, totals):
            at = np.flatnonzero(total)
            slices, first = np.unique(at // SLICE, return_index=True)
            cuts = [*first.tolist(), len(at)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(slices), shard)), pa.array(slices.astype(np.int32)),
                 pa.array([(at[a:b] % SLICE).astype(np.uint16).tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
                 pa.array([total[at[a:b]].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())],
                ["shard", "slice", "states", "counts"])

    return run


def _summed(least: int):
    """Sums of the slices, which come ordered, where they reach ``least``."""
    def total(key: tuple[int, int], sums: np.ndarray) -> pa.RecordBatch:
        at = np.flatnonzero(sums >= least)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), key[0])), pa.array((key[1] * SLICE + at).astype(np.int32)), pa.array(sums[at])],
            ["shard", "state", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, np.zeros(SLICE, np.int64)
        for batch in batches:
            for shard, part, states, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if (shard, part) != now:
                    if now:
                        yield total(now, sums)
                    now, sums = (shard, part), np.zeros(SLICE, np.int64)
                sums[np.frombuffer(states, np.uint16)] += np.frombuffer(counts, np.int64)
        if now:
            yield total(now, sums)

    return run


def _level_one(tokens: DataFrame, least: int, folder: str) -> tuple[DataFrame, DataFrame, bool]:
    """All words with their counts; the frequent ones; whether each of these has a hash of its own."""
    each = tokens.select("lang", F.inline(F.arrays_zip("words", "hashes", "counts")))
    words = written(each.groupBy("lang", F.col("hashes").alias("last"), F.col("words").alias("word")).agg(
        F.sum("counts").alias("f")), f"{folder}/words")
    frequent = written(words.groupBy("lang", "last").agg(F.sum("f").alias("f"), F.count("*").alias("forms"))
                       .where(F.col("f") >= least).mapInArrow(
        _coded, "lang string, last bigint, f bigint, forms bigint, code bigint"), f"{folder}/level-1")
    return words, frequent, frequent.where("forms > 1").isEmpty()


def _candidates(tokens: DataFrame, frequent: DataFrame, least: int, folder: str) -> DataFrame:
    """``lang, n, w1 ... w4`` of the phrases of two to four words whose nominations reach ``least``; unused words are 0."""
    context = tokens.sparkSession.sparkContext
    none = F.lit(0).cast("bigint")
    known = frequent.select("lang", F.array("last").alias("words"), "code")
    level, filters, found = frequent, [], []
    for n in range(2, len(_WORDS) + 1):
        filters.append(context.broadcast(_filter(level)))
        rows = tokens.select("lang", "hashes", "codes").mapInArrow(_nominated(list(filters)), "prefix bigint, last bigint, n bigint")
        sums = rows.repartition("prefix", "last").groupBy("prefix", "last").agg(F.sum("n").alias("n"))
        level = written(sums.where(F.col("n") >= least).select("prefix", "last").mapInArrow(
            _coded, "prefix bigint, last bigint, code bigint"), f"{folder}/level-{n}")
        known = written(level.join(known.select("lang", "words", F.col("code").alias("prefix")), "prefix").select(
            "lang", F.concat("words", F.array("last")).alias("words"), "code"), f"{folder}/phrases-{n}")
        found.append(known.select("lang", F.lit(n).alias("n"), *(
            (F.col("words")[i] if i < n else none).alias(w) for i, w in enumerate(_WORDS))))
    for bits in filters:
        bits.destroy()
    return found[0].unionByName(found[1]).unionByName(found[2])


def _trie_counts(tokens: DataFrame, phrases: DataFrame, least: int, folder: str) -> DataFrame:
    """``lang, n, w1 ... w4, f`` of the phrases that occur ``least`` times or more, counted through tries."""
    spark = tokens.sparkSession
    shards = phrases.groupBy("lang").agg(F.ceil(F.count("*") / F.lit(TRIE_PHRASES)).alias("shards"))  # one row per language
    own = F.pmod(F.xxhash64(*_WORDS), F.col("shards"))
    dealt = phrases.join(shards, "lang").withColumn("shard", F.xxhash64("lang", own)).drop("shards")
    made = written(dealt.repartition("shard").sortWithinPartitions("shard", *_WORDS).mapInArrow(
        _compiled, "lang string, shard bigint, vocabulary binary, base binary, check binary, state int, n int, "
        + ", ".join(f"{w} bigint" for w in _WORDS)), f"{folder}/tries")
    whole = made.where("state IS NULL")
    sizes = whole.select("shard", (F.octet_length("vocabulary") + F.octet_length("base") + F.octet_length("check"))
                         .alias("bytes")).orderBy("shard").collect()  # one row per trie
    groups: list[list[int]] = []
    total = BROADCAST_BYTES
    for row in sizes:
        if total + row["bytes"] > BROADCAST_BYTES:
            groups.append([])
            total = 0
        groups[-1].append(row["shard"])
        total += row["bytes"]
    counts = None
    for number, names in enumerate(groups):
        rows = whole.where(F.col("shard").isin(names)).select("shard", "lang", "vocabulary", "base", "check").collect()
        group = spark.sparkContext.broadcast([tuple(r) for r in rows])  # at most BROADCAST_BYTES, or one trie
        reached = tokens.select("lang", "hashes", "codes").mapInArrow(
            _counted(group), "shard bigint, slice int, states binary, counts binary")
        part = written(reached.repartition("shard", "slice").sortWithinPartitions("shard", "slice").mapInArrow(
            _summed(least), "shard bigint, state int, f bigint"), f"{folder}/counts-{number}")
        group.destroy()
        counts = part if counts is None else counts.unionByName(part)
    if counts is None:
        counts = spark.createDataFrame([], "shard bigint, state int, f bigint")
    return written(made.where("state IS NOT NULL").join(counts, ["shard", "state"]).select("lang", "n", *_WORDS, "f"),
                   f"{folder}/counted")


def _runs(n: int, spans: list[tuple[int, int, int]]) -> Column:
    """``(tag, m, x1, x2, x3)`` for stretches of words of a phrase, given as tag, first word and number of words."""
    none = F.lit(0).cast("bigint")
    return F.array(*(F.struct(F.lit(tag).alias("tag"), F.lit(m).alias("m"), *(
        (F.col(_WORDS[begin + i]) if i < m else none).alias(f"x{i + 1}") for i in range(3))) for tag, begin, m in spans))


def _stretches(spans) -> Column:
    """All stretches of a phrase of its own length."""
    found = F.when(F.col("n") == 2, _runs(2, spans(2)) if spans(2) else None)
    return found.when(F.col("n") == 3, _runs(3, spans(3))).when(F.col("n") == 4, _runs(4, spans(4)))


def _scored(phrases: DataFrame, frequent: DataFrame, scale: int) -> DataFrame:
    """Each phrase with ``l``, ``r`` and ``score`` of its lowest cut."""
    part = ["lang", "m", "x1", "x2", "x3"]
    none = F.lit(0).cast("bigint")
    known = frequent.select("lang", F.lit(1).alias("m"), F.col("last").alias("x1"), none.alias("x2"), none.alias("x3"), "f")
    known = known.unionByName(phrases.where("n < 4").select(
        "lang", F.col("n").alias("m"), *(F.col(w).alias(x) for w, x in zip(_WORDS, part[2:])), "f"))
    sides = phrases.withColumnRenamed("f", "a").select(
        "lang", "n", *_WORDS, "a", F.inline(_stretches(lambda n: [
            span for k in range(1, n) for span in ((2 * k, 0, k), (2 * k + 1, k, n - k))])))
    counts = sides.join(known, part).groupBy("lang", "n", *_WORDS, "a").agg(*(
        F.max(F.when(F.col("tag") == 2 * k + side, F.col("f"))).alias(f"{name}{k}")
        for k in (1, 2, 3) for side, name in enumerate("lr")))
    # Decimals: the product may leave 64 bits. A cut's number is kept below its score, so ties go to the first.
    cut = [F.expr(f"CAST(({scale}BD * CAST(a AS DECIMAL(20,0))) div (CAST(l{k} AS DECIMAL(20,0)) + CAST(r{k} AS DECIMAL(20,0)))"
                  f" AS BIGINT) * 4 + {k}") for k in (1, 2, 3)]
    lowest = counts.withColumn("cut", F.least(*cut))
    k = F.col("cut") % 4
    return lowest.select("lang", "n", *_WORDS, "a", *(
        F.when(k == 1, F.col(f"{s}1")).when(k == 2, F.col(f"{s}2")).otherwise(F.col(f"{s}3")).alias(s) for s in "lr"),
        F.expr("cut div 4").alias("score"))


def _independent(scored: DataFrame, phrases: DataFrame, inside: tuple[int, int]) -> DataFrame:
    """Phrases that no longer candidate holds in ``inside[0] / inside[1]`` or more of their occurrences."""
    part = ["lang", "m", "x1", "x2", "x3"]
    held = phrases.where("n > 2").select("lang", "f", F.inline(_stretches(lambda n: [
        (0, begin, m) for m in range(2, n) for begin in range(n - m + 1)])))
    longest = held.groupBy(*part).agg(F.max("f").alias("longest")).select(
        "lang", F.col("m").alias("n"), *(F.col(x).alias(w) for x, w in zip(part[2:], _WORDS)), F.lit(0).cast("bigint").alias("w4"),
        "longest")
    whole = scored.join(longest, ["lang", "n", *_WORDS], "left")
    most = F.expr(f"{inside[1]}BD * CAST(longest AS DECIMAL(20,0)) >= {inside[0]}BD * CAST(a AS DECIMAL(20,0))")
    return whole.where(F.col("longest").isNull() | ~most).drop("longest")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, top: int = 2000,
                 inside: tuple[int, int] = (80, 100), scale: int = 2_000_000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of two to four words of each language.

    A-Z are lower-cased. Texts are cut at ``.,;:!?`` and line ends; words are what blanks and tabs separate in a piece. ``n``
    is the number of words of the language, ``a`` of occurrences of the phrase, overlaps included; ``l`` and ``r`` of the two
    parts of its cut with the lowest ``floor(scale * a / (l + r))``, ties to the first cut. Candidates occur ``least`` times; those held
    by a longer candidate in ``inside[0] / inside[1]`` of their occurrences are left out. Ranks follow the
    score, then ``a``, then the phrase in the order of its UTF-8 bytes.

    A NULL language is ``und``, a NULL text is empty; texts without words, languages without candidates and empty tables give no rows. Repeated
    rows count as rows each. Other columns are ignored. Word hashes are checked: where a frequent word shares its own with
    another, the work starts again with other hashes.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "collocations")
    rows = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))
    seed, alone = 0, False
    while not alone:
        path = f"{folder}/{seed}"
        tokens = written(rows.mapInArrow(
            _tokens(seed, STRETCH_BYTES),
            "lang string, words array<binary>, hashes array<bigint>, counts array<bigint>, codes binary"), f"{path}/tokens")
        words, frequent, alone = _level_one(tokens, least, path)
        seed += 1
    phrases = _trie_counts(tokens, _candidates(tokens, frequent, least, path), least, path)
    for stage in ("tokens", "tries", *(f"{kind}-{n}" for n in (2, 3, 4) for kind in ("level", "phrases"))):
        removed(spark, f"{path}/{stage}")
    best = written(_independent(_scored(phrases, frequent, scale), phrases, inside), f"{path}/scored")
    # Most rows go before the words are fetched: those beyond the limit in their own share of a language.
    salts = max(1, -(-best.count() // SALT_ROWS))
    best = best.withColumn("salt", F.pmod(F.xxhash64(*_WORDS), F.lit(salts)))
    share = Window.partitionBy("lang", "salt").orderBy(F.desc("score"), F.desc("a"))
    best = best.withColumn("place", F.rank().over(share)).where(F.col("place") <= top).drop("place", "salt")
    for i, w in enumerate(_WORDS):
        names = words.where(F.col("f") >= least).select(
            "lang", F.col("last").alias(w), F.col("word").cast("string").alias(f"word{i}"))
        best = best.join(names, ["lang", w], "left")
    totals = words.groupBy("lang").agg(F.sum("f").alias("total"))  # one row per language
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    named = best.select("lang", F.concat_ws(" ", *(f"word{i}" for i in range(4))).alias("phrase"), "a", "l", "r", "score")
    ranked = named.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
