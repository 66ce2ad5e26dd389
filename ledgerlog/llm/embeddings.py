"""Near-duplicate vectors by sorted projection passes.

A pass gives each vector the signs of random projections, concatenated to one number. The vectors
of a label are ordered by it, and each is compared with at least the next ``CELL`` ones: blocks of
that many, each with itself and the one after. Vectors whose first bits agree follow one another
(a cell); a cell that is larger than a window is compared in full, in blocks of bounded size, so
that every cell is compared whole, however many share it. Links of all passes are united. Before
that, dense groups are folded: in the order of the numbers, a vector joins a leader among the last
ones when it lies within half the threshold angle, so that all members of a leader are linked to one
another by the triangle inequality, and a group of thousands of copies needs no list of pairs.
Every vector then brings its leader into its own cell: leaders of linked members may lie
twice the angle apart, but the members themselves lie within it. Between leaders, a member is
linked to all, to none, or compared one by one with the members
of another leader, again by the angles to the leader.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from ..operators.windows import dense_ids
from .components import connected
from .shared import scratch, written

WINDOW = 64
FOLDS = 3
RECALL = 0.9999
BITS = 62
CELL = 1024
BLOCK = 2048
STRIP = 256
SLACK = 1e-7
#: In place of a cell: rows of a window of the order.
ORDER = -1


def bits_for(n: int, cell: int = CELL) -> int:
    """Leading bits that name a cell, so that ``n`` evenly spread vectors fill cells of at most ``cell``."""
    return max(0, ceil(log2(max(n, 1) / cell)))


def passes_for(n: int, cosine: float, cell: int = CELL, recall: float = RECALL) -> int:
    """Passes in which a pair at the threshold shares a cell at least once with probability ``recall``.

    Each bit agrees with probability 1 - angle / pi, whatever other vectors there are.
    """
    meet = (1 - acos(cosine) / pi) ** bits_for(n, cell)
    return 1 if meet > recall else ceil(log(1 - recall) / log(1 - meet))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Packed vectors as rows of doubles, each divided by a power of two: no cosine changes, no square overflows."""
    packed = b"".join(column.to_pylist())
    number = np.float32 if len(packed) == 4 * dim * len(column) else np.float64
    rows = np.frombuffer(packed, number).reshape(-1, dim).astype(float)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1))[1][:, None])


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1)[:, None]


def _projections(dim: int, number: int) -> np.ndarray:
    return np.random.default_rng([dim, number]).standard_normal((dim, BITS))


def _bundles(number: type):
    """Usable vectors: labelled, finite, not zero; packed in the type they came in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, label, vector in zip(*(batch.column(c).to_pylist() for c in ("id", "label", "vector"))):
                if key is None or label is None or not vector or None in vector:
                    continue
                values = np.array(vector, number)
                if np.isfinite(values).all() and values.any():
                    rows.append({"id": key, "label": label, "dim": len(values), "vector": values.tobytes()})
            yield pa.RecordBatch.from_pylist(rows, pa.schema(
                [("id", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()), ("vector", pa.binary())]))

    return run


def _numbers(rows: np.ndarray, number: int) -> np.ndarray:
    """The concatenated signs of each row in a pass."""
    signs = (rows @ _projections(rows.shape[1], number) > 0).astype(np.int64)
    return signs @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def _keyed(numbers: list[int], rest: list[str]):
    """Each vector once per pass, with its sort key there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                rows = matrix(part.column("vector"), dim)
                for number in numbers:
                    yield pa.RecordBatch.from_arrays(
                        [*(part.column(c) for c in rest), pa.array(np.full(len(rows), number, np.int32)),
                         pa.array(_numbers(rows, number))], [*rest, "pass", "key"])

    return run


def _runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Stretches of rows equal in ``keys``, cut at batch ends."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy() for k in keys])
        cuts = [0, *(np.flatnonzero((values[:, 1:] != values[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield tuple(values[:, a].tolist()), batch.slice(a, b - a)


def _folded(limit: float, window: int):
    """Each leader with the one it joins: itself, or one of the last ``window`` kept in the order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, kept, count = None, None, None, 0
        for key, part in _runs(batches, ("label", "dim", "pass")):
            if key != now:
                now, count = key, 0
                kept, ids = np.zeros((window, key[1])), np.zeros(window, np.int64)
            rows = unit(matrix(part.column("vector"), key[1]))
            own, radius = part.column("id").to_numpy(), part.column("radius").to_numpy()
            leader, reach = own.copy(), radius.copy()
            for i, row in enumerate(rows):
                if count:
                    near = kept[:min(count, window)] @ row
                    best = int(near.argmax())
                    far = acos(min(1.0, near[best])) + radius[i] + SLACK
                    if far <= limit:
                        leader[i], reach[i] = ids[best], far
                        continue
                kept[count % window], ids[count % window] = row, own[i]
                count += 1
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(leader), pa.array(reach)],
                                             ["id", "leader", "reach"])

    return run


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of each vector in each pass of its label, and its cell, with the vector's leader."""
    for batch in batches:
        dims, passes, bits = (batch.column(c).to_numpy() for c in ("dim", "passes", "bits"))
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            rows = matrix(batch.take(pa.array(at)).column("vector"), dim)
            for number in range(int(passes[at].max())):
                more = np.flatnonzero(passes[at] > number)
                part = batch.take(pa.array(at[more]))
                keys = _numbers(rows[more], FOLDS + number)
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), part.column("dim"), pa.array(np.full(len(more), number, np.int32)),
                     pa.array(keys), pa.array(keys >> (BITS - bits[at[more]])), part.column("leader")],
                    ["label", "dim", "pass", "key", "cell", "leader"])


def _near(angle: float, cosine: float):
    """Pairs of leaders in two blocks whose members may be linked; ``sure`` if both stand alone and are.

    Block ``i`` of a cell is compared with block ``j``, which may be itself; block ``i`` of the order with
    itself and the next one.
    """
    def met(dim: int, cell: int, i: int, j: int, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts)
        raw = matrix(table.column("vector"), dim)
        rows = unit(raw)
        ids, radius, size, own = (table.column(c).to_numpy() for c in ("leader", "radius", "size", "own"))
        left = np.flatnonzero(own == i)
        right = np.arange(len(own)) if cell == ORDER else np.flatnonzero(own == j)
        if not len(left) or not len(right):
            return
        for begin in range(0, len(left), STRIP):
            strip = left[begin:begin + STRIP]
            near = rows[strip] @ rows[right].T
            widest = angle + radius[strip].max() + radius[right].max() + SLACK
            a, b = np.nonzero(near >= np.cos(min(pi, widest)) - SLACK)
            value, a, b = near[a, b], strip[a], right[b]
            hit = np.arccos(np.clip(value, -1, 1)) <= angle + radius[a] + radius[b] + SLACK
            hit &= ((a < b) | (own[b] != i)) & (ids[a] != ids[b])  # a leader has a place in each cell of its members
            value, a, b = value[hit], a[hit], b[hit]
            alone = (size[a] == 1) & (size[b] == 1)
            for k in np.flatnonzero(alone & (np.abs(value - cosine) < SLACK)).tolist():
                x, y = raw[a[k]], raw[b[k]]
                value[k] = np.einsum("i,i->", x, y) / (np.linalg.norm(x) * np.linalg.norm(y))
            sure = alone & (value >= cosine)
            keep = sure | ~alone
            p, q = ids[a[keep]], ids[b[keep]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q)), pa.array(sure[keep])], ["p", "q", "sure"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for key, part in _runs(batches, ("label", "dim", "pass", "cell", "i", "j")):
            if key != now and parts:
                yield from met(now[1], *now[3:], parts)
                parts = []
            now = key
            parts.append(part)
        if parts:
            yield from met(now[1], *now[3:], parts)

    return run


def _cosines(left: str, right: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosine = np.zeros(batch.num_rows)
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                part = batch.take(pa.array(at))
                a, b = matrix(part.column(left), dim), matrix(part.column(right), dim)
                cosine[at] = np.einsum("ij,ij->i", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(cosine)], [*keep, "cosine"])

    return run


def _ordered(leaders: DataFrame, numbers: list[int]) -> DataFrame:
    rest = ["id", "label", "dim", "vector", "radius"]
    keyed = leaders.select(rest).mapInArrow(
        _keyed(numbers, rest), "id bigint, label bigint, dim int, vector binary, radius double, pass int, key bigint")
    order = ["label", "dim", "pass", "key", "id"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order)


def _blocks(entries: DataFrame, leaders: DataFrame, window: int, path: str) -> DataFrame:
    """The leaders to be compared in one go, with their vectors.

    Of the order: each block of ``window`` with the one after. Of each cell beyond a window: once for each
    pair of blocks of the cell they belong to.
    """
    cell = ["label", "dim", "pass", "cell"]
    order = F.struct("label", "dim", "pass", "key", "leader").alias("place")
    numbered = dense_ids(entries.select(order), "place", "rank", path, start=0).withColumn(
        "own", F.floor(F.col("rank") / window))
    windows = numbered.withColumn("i", F.explode(F.array("own", F.col("own") - 1))).where("i >= 0").select(
        "place.label", "place.dim", "place.pass", F.lit(ORDER).cast("bigint").alias("cell"), "i",
        (F.col("i") + 1).alias("j"), "own", "place.leader")
    sizes = (entries.groupBy(cell).agg(F.count("*").alias("n")).where(F.col("n") > window)
             .select(*cell, F.ceil(F.col("n") / BLOCK).alias("blocks")))
    full = (entries.join(sizes, cell).withColumn("own", F.pmod(F.xxhash64("leader"), "blocks"))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
            .select(*cell, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "leader"))
    heads = leaders.select(F.col("id").alias("leader"), "vector", "radius", "size")
    return (windows.unionByName(full).join(heads, "leader").repartition(*cell, "i", "j")
            .sortWithinPartitions(*cell, "i", "j", "leader"))


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | None = "label",
                 cosine: float = 0.93, window: int = WINDOW, cell: int = CELL) -> DataFrame:
    """One row per vector: ``key``, ``n_links``, ``component_id``, ``kept``.

    Vectors of equal labels (without ``label``: all) are linked when their cosine, in double
    precision, is ``cosine`` or more; ``component_id`` is the smallest key reachable over links.
    Found pairs are exact. A label of n leaders takes as many passes as let a pair at the threshold be
    met with probability ``RECALL``, closer ones more often, however many vectors lie around it; while they
    fill one window of ``cell``, a pass compares them all. ``window`` is the number of leaders a vector may
    fold onto. Vectors of floats stay floats, all others are doubles. NULL, empty and zero vectors, NULL or non-finite components and NULL labels
    are linked with nothing. Rows with a NULL key keep NULL as component and are kept. Rows that
    share a key are one vector, any of them, and appear as often as they came. Other columns are
    ignored; an empty table gives an empty result. Keys and labels must be integers.
    """
    spark = vectors.sparkSession
    folder = scratch(spark, "vectors")
    angle = acos(cosine)
    given = vectors.select(F.col(f"`{vector}`")).schema[0].dataType
    narrow = isinstance(given, ArrayType) and isinstance(given.elementType, FloatType)
    rows = vectors.select(
        F.col(f"`{key}`").cast("bigint").alias("id"),
        (F.col(f"`{label}`") if label else F.lit(0)).cast("bigint").alias("label"),
        F.col(f"`{vector}`").cast("array<float>" if narrow else "array<double>").alias("vector"))
    base = written(rows.mapInArrow(_bundles(np.float32 if narrow else np.float64), "id bigint, label bigint, dim int, vector binary").dropDuplicates(["id"]),
                   f"{folder}/vectors")

    leaders = base.withColumn("radius", F.lit(0.0))
    groups = base.select("id", F.col("id").alias("leader"))
    for fold in range(FOLDS):
        joined = written(_ordered(leaders, [fold]).mapInArrow(
            _folded(angle / 2, window), "id bigint, leader bigint, reach double"), f"{folder}/fold-{fold}")
        radius = joined.groupBy("leader").agg(F.max("reach").alias("radius"))
        leaders = base.join(radius, F.col("id") == F.col("leader")).drop("leader")
        moved = joined.select(F.col("id").alias("leader"), F.col("leader").alias("to"))
        groups = groups.join(moved, "leader").select("id", F.col("to").alias("leader"))
    leaders = written(leaders.join(groups.groupBy(F.col("leader").alias("id")).agg(F.count("*").alias("size")), "id"),
                      f"{folder}/leaders")
    groups = written(groups, f"{folder}/groups")

    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / cell))).cast("int")
    meet = F.pow(F.lit(1 - angle / pi), "bits")
    passes = F.when(meet > RECALL, 1).otherwise(F.ceil(log(1 - RECALL) / F.log(1 - meet))).cast("int")
    sizes = (leaders.groupBy("label", "dim").agg(F.count("*").alias("n")).withColumn("bits", bits)
             .select("label", "dim", "bits", passes.alias("passes")))
    entries = written(
        groups.join(base, "id").join(sizes, ["label", "dim"])
        .select("label", "dim", "leader", "vector", "bits", "passes").mapInArrow(
            _placed, "label bigint, dim int, pass int, key bigint, cell bigint, leader bigint")
        .groupBy("label", "dim", "pass", "cell", "leader").agg(F.min("key").alias("key")), f"{folder}/cells")
    near = written(_blocks(entries, leaders, cell, f"{folder}/order").mapInArrow(
        _near(angle, cosine), "p bigint, q bigint, sure boolean").dropDuplicates(["p", "q"]), f"{folder}/near")

    turned = near.unionByName(near.select(F.col("q").alias("p"), F.col("p").alias("q"), "sure"))
    both = turned.where("NOT sure").select("p", "q")
    known = turned.where("sure").select(F.col("p").alias("a"), "p", "q", F.lit(1).cast("bigint").alias("n"))
    members = groups.join(base, "id").select(F.col("leader").alias("p"), F.col("id").alias("a"), "dim",
                                             F.col("vector").alias("va"))
    heads = leaders.select(F.col("id").alias("q"), F.col("vector").alias("vq"), "radius", "size")
    asked = both.join(members, "p").join(heads, "q").mapInArrow(
        _cosines("va", "vq", ["a", "p", "q", "dim", "va", "radius", "size"]),
        "a bigint, p bigint, q bigint, dim int, va binary, radius double, size bigint, cosine double")
    away = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), "cosine")))
    asked = asked.withColumn("all", F.when(F.col("size") == 1, F.col("cosine") >= cosine).otherwise(
        away + F.col("radius") + SLACK <= angle))
    asked = written(asked.where((F.col("all") | (F.col("size") > 1)) & (away - F.col("radius") - SLACK <= angle)),
                    f"{folder}/asked")
    certain = asked.where("all").select("a", "p", "q", F.col("size").alias("n"))
    others = members.select(F.col("p").alias("q"), F.col("a").alias("b"), F.col("va").alias("vb"))
    counted = (asked.where("NOT all").select("a", "p", "q", "dim", "va").join(others, "q")
               .mapInArrow(_cosines("va", "vb", ["a", "p", "q"]), "a bigint, p bigint, q bigint, cosine double")
               .where(F.col("cosine") >= cosine).groupBy("a", "p", "q").agg(F.count("*").alias("n")))
    links = written(certain.unionByName(counted).unionByName(known), f"{folder}/links")

    joined = connected(links.select(F.col("p").alias("a"), F.col("q").alias("b")), f"{folder}/components")
    placed = groups.join(joined, F.col("leader") == F.col("node"), "left").select(
        "id", "leader", F.coalesce("component", "leader").alias("component"))
    least = placed.groupBy("component").agg(F.min("id").alias("least"))
    outside = links.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("outside"))
    found = (placed.join(least, "component").join(leaders.select(F.col("id").alias("leader"), "size"), "leader")
             .join(outside, "id", "left")
             .select("id", (F.col("size") - 1 + F.coalesce("outside", F.lit(0))).alias("n"), "least"))
    component = F.coalesce("least", "id")
    return rows.select("id").join(found, "id", "left").select(
        F.col("id").alias(key), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
