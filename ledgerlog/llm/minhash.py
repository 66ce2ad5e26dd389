"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact links.

Method: a document's set is its distinct ``words``-word shingles. Equal sets become one class.
Band keys of a MinHash signature propose pairs; signature batches are compared one after the
other and a pair goes as soon as the posterior probability that its similarity reaches the
threshold (uniform prior) is below ``miss``; survivors are confirmed on the full sets.

Components need no list of all pairs. Each member of a bucket is first compared with the
bucket's smallest member only. Where a bucket still holds several components, the members
outside its largest one are compared with all others of different components, in blocks of
bounded size, so no hot bucket is gathered and no link between different texts is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .components import connected
from .shared import pieces, scratch, written

BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
BATCH = 32
MISS = 1e-5
BLOCK = 512

_RNG = np.random.default_rng(7411)
_A = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(1, 2**63, HASHES, dtype=np.uint64)


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than ``width`` make one shingle."""
    found = W.split(texts, W.BLANK_SEPARATED)
    values = W.hashes(found)
    every = W.runs(values, width)
    sets = []
    for begin, end in zip(found.offsets[:-1].tolist(), found.offsets[1:].tolist()):
        if end - begin >= width:
            sets.append(np.unique(every[begin:end - width + 1]))
        elif end > begin:
            sets.append(W.runs(values[begin:end], end - begin))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 32-bit minima per set; empty sets get zeros."""
    sizes = np.array([len(s) for s in sets])
    signs = np.zeros((len(sets), HASHES), np.uint32)
    full = np.flatnonzero(sizes)
    if len(full):
        values = np.concatenate([sets[i] for i in full])
        heads = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        for k in range(HASHES):
            signs[full, k] = np.minimum.reduceat(values * _A[k] + _B[k], heads) >> np.uint64(32)
    return signs


def band_keys(signs: np.ndarray) -> np.ndarray:
    keys = np.empty((len(signs), BANDS), np.uint64)
    for band in range(BANDS):
        value = np.full(len(signs), band, np.uint64)
        for k in range(band * ROWS, band * ROWS + ROWS):
            value = W.mix(value * np.uint64(0xBF58476D1CE4E5B9) + signs[:, k].astype(np.uint64))
        keys[:, band] = value
    return keys.view(np.int64)


def _lists(values: np.ndarray) -> pa.Array:
    flat = pa.array(values.ravel(), pa.int64())
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]), flat)


def least_matches(threshold: float, miss: float) -> list[tuple[int, int]]:
    """For each batch end n: the smallest m with P(similarity >= threshold | m of n equal) >= miss.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), whose upper tail is a binomial sum.
    """
    steps = []
    for n in range(BATCH, HASHES + 1, BATCH):
        tail, m = 0.0, -1
        while tail < miss:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        steps.append((n, m))
    return steps


def plausible(left: np.ndarray, right: np.ndarray, steps: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Which rows survive every batch, and how many of their values are equal."""
    alive = np.arange(len(left))
    equal = np.zeros(len(left), np.int32)
    begin = 0
    for end, least in steps:
        equal[alive] += (left[alive, begin:end] == right[alive, begin:end]).sum(1, dtype=np.int32)
        alive = alive[equal[alive] >= least]
        begin = end
    return alive, equal[alive]


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, on sorted distinct values."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _digests(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sets = shingle_sets(batch.column("text"), width)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                 _lists(band_keys(signatures(sets)))], ["id", "n", "set_id", "bands"])

    return run


def _nodes(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            sets = shingle_sets(batch.column("text"), width)
            signs = signatures(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([s.tobytes() for s in signs], pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "sign", "shingles"])

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def _pruned(percent: int, miss: float):
    steps = least_matches(percent / 100, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                alive, _ = plausible(_matrix(batch.column("sign_a")), _matrix(batch.column("sign_b")), steps)
                yield batch.select(["a", "b"]).take(pa.array(alive))

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [similar(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64), percent)
                    for a, b in zip(batch.column("set_a"), batch.column("set_b"))]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _blocks(percent: int, miss: float):
    """Links across components within one block; one link between two components is enough."""
    steps = least_matches(percent / 100, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches)
        band = rows.column("band")[0].as_py()
        minor, asks = (rows.column(c).to_numpy() for c in ("minor", "asks"))
        ids, comps = (rows.column(c).to_numpy() for c in ("id", "comp"))
        signs = _matrix(rows.column("sign"))
        keys = np.array(rows.column("bands").to_pylist(), np.int64)
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("shingles")]
        sizes = np.array([len(s) for s in sets])
        left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
        possible = comps[left][:, None] != comps[right]
        possible &= ~(minor[right] & (ids[left][:, None] >= ids[right]))
        low = np.minimum(sizes[left][:, None], sizes[right])
        possible &= 100 * low >= percent * np.maximum(sizes[left][:, None], sizes[right])
        for earlier in range(band):
            possible &= keys[left, earlier][:, None] != keys[right, earlier]
        i, j = (x for x in np.nonzero(possible))
        i, j = left[i], right[j]
        alive, equal = plausible(signs[i], signs[j], steps) if len(i) else (i, i)
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while x in parent:
                x = parent[x]
            return x

        links = []
        for k in alive[np.argsort(-equal, kind="stable")].tolist():
            p, q = root(int(comps[i[k]])), root(int(comps[j[k]]))
            if p != q and similar(sets[i[k]], sets[j[k]], percent):
                parent[max(p, q)] = min(p, q)
                links.append((int(comps[i[k]]), int(comps[j[k]])))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])

    return run


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80,
                    miss: float = MISS) -> DataFrame:
    """One row per document: ``key``, ``n_shingles``, ``component_id``, ``kept``.

    Two documents are linked when 100 * shared shingles >= ``percent`` * all their shingles;
    ``component_id`` is the smallest key reachable over links. A pair at the threshold is
    proposed by no band with probability (1 - 0.8^5)^32, about 3e-6.

    NULL and blank texts have no shingles and are linked with nothing. Rows with a NULL key
    keep a NULL component and are kept. Repeated rows appear as often as they came; rows that
    share a key are one document. Other columns of ``docs`` are ignored; an empty table gives
    an empty result. ``key`` must be an integer column.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "minhash")
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    base = written(rows.mapInArrow(_digests(words), "id bigint, n bigint, set_id binary, bands array<bigint>"),
                   f"{folder}/sets")
    solid = base.where("n > 0 AND id IS NOT NULL")
    classes = solid.groupBy("set_id").agg(F.min("id").alias("rep"), F.max("id").alias("last"))
    copies = (solid.join(classes.where("rep < last"), "set_id").where("id <> rep").select("id"))
    keyed = written(
        solid.join(copies, "id", "left_anti").select("id", F.posexplode("bands").alias("band", "key")).distinct(),
        f"{folder}/keys")
    buckets = keyed.groupBy("band", "key").agg(F.min("id").alias("pivot"), F.max("id").alias("last"))
    members = written(keyed.join(buckets.where("pivot < last").drop("last"), ["band", "key"]), f"{folder}/members")
    involved = members.select("id").distinct()
    nodes = written(
        rows.join(involved, "id", "left_semi").mapInArrow(_nodes(words), "id bigint, sign binary, shingles binary")
        .dropDuplicates(["id"]), f"{folder}/nodes")

    pairs = members.where("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
    likely = (_with(_with(pairs, nodes, "a", "sign"), nodes, "b", "sign")
              .mapInArrow(_pruned(percent, miss), "a bigint, b bigint"))
    likely = written(likely, f"{folder}/likely")
    sure = (_with(_with(likely, nodes, "a", "shingles", "set_a"), nodes, "b", "shingles", "set_b")
            .mapInArrow(_confirmed(percent), "a bigint, b bigint"))
    stars = written(connected(sure, f"{folder}/first"), f"{folder}/stars")

    placed = written(
        members.drop("pivot").join(stars, F.col("id") == F.col("node"), "left")
        .select("band", "key", "id", F.coalesce("component", "id").alias("comp")), f"{folder}/placed")
    shares = placed.groupBy("band", "key", "comp").agg(F.count("*").alias("n"))
    mixed = (shares.groupBy("band", "key")
             .agg(F.max_by("comp", "n").alias("big"), F.sum("n").alias("total"), F.max("n").alias("most"))
             .where("total > most")
             .select("band", "key", "big", F.ceil((F.col("total") - F.col("most")) / BLOCK).alias("n_ask"),
                     F.ceil(F.col("total") / BLOCK).alias("n_all")))
    open_rows = placed.join(mixed, ["band", "key"]).withColumn("minor", F.col("comp") != F.col("big"))
    place = F.xxhash64("id")
    asking = open_rows.where("minor").select(
        "band", "key", "id", "comp", "minor", F.lit(True).alias("asks"), F.pmod(place, "n_ask").alias("i"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_all") - 1)).alias("j"))
    asked = open_rows.select(
        "band", "key", "id", "comp", "minor", F.lit(False).alias("asks"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_ask") - 1)).alias("i"),
        F.pmod(place, "n_all").alias("j"))
    wide = nodes.join(base.where("n > 0").select("id", "bands").dropDuplicates(["id"]), "id")
    across = (asking.unionByName(asked).join(wide, "id").groupBy("band", "key", "i", "j")
              .applyInArrow(_one_table(_blocks(percent, miss)), "a bigint, b bigint"))
    joined = connected(across, f"{folder}/second")

    merged = (stars.join(joined.select(F.col("node").alias("component"), F.col("component").alias("whole")),
                         "component", "left")
              .select("node", F.coalesce("whole", "component").alias("component"))
              .unionByName(joined.join(stars.select("node"), "node", "left_anti").select("node", "component")))
    found = (classes.join(merged, F.col("rep") == F.col("node"), "left")
             .select("set_id", F.coalesce("component", "rep").alias("component")))
    known = base.withColumn("set_id", F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.col("set_id")))
    return known.join(found, "set_id", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component", "id")).alias("kept"))


def _with(pairs: DataFrame, nodes: DataFrame, side: str, column: str, name: str | None = None) -> DataFrame:
    return pairs.join(nodes.select(F.col("id").alias(side), F.col(column).alias(name or f"{column}_{side}")), side)


def _one_table(run):
    """``applyInArrow`` hands a table; the block function wants its batches."""
    def apply(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(run(table.to_batches()))

    return apply
