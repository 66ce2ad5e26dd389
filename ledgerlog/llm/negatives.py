"""Hard negatives by threshold joins over an inverted index with norm bounds (after L2AP).

Components become integers, so scores are exact. Rows are packed into blocks and dealt to shards of
bounded size; each shard sees every anchor once a round, in batches. Components are visited in one order,
heaviest first. For a batch of anchors a row is indexed only up to the component from which the norm
of its suffix times the norms of the anchors' suffixes stays below their thresholds; the lists of a stretch of components are the rows
that reach it. Partial scores are accumulated stretch by stretch; a pair goes
when its partial score and the remaining norms cannot reach the anchor's threshold any more, or cannot come back below its
upper limit. Scores of the pairs left are computed in full.

A window asks for the ``k`` best rows of an anchor between two scores. It starts with a threshold that few
rows should reach; in a shard the threshold rises once ``k`` rows are found, and windows that all
shards together could not fill come back next round with a lower one, at last with their lower limit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import removed, scratch, written

BLOCK_ROWS = 1024
BLOCK_BYTES = 1 << 20
SHARD_BYTES = 16 << 20
BATCH = 256
STRETCH = 16
PAIRS = 1 << 16
#: Rows a window is expected to find in its first round, per row asked for, and the growth of that each round.
FIRST, GROWTH = 16, 16
#: Vectors whose integer norm reaches this could have scores beyond 64 bits.
LONGEST = float(2**31)
LEAST, MOST = -2**63, 2**63 - 1
SLACK = 1e-9

_BLOCKS = "block bigint, dim int, ids binary, labels binary, asks binary, rows binary"
_ASKS = "anchor bigint, label bigint, dim int, vector binary"


def _blocks(scale: float):
    """Usable rows as integers, packed by length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = (TaskContext.get().partitionId() << 32) - 1
        for batch in batches:
            batch = batch.filter(pc.and_(batch.column("id").is_valid(), pc.and_(
                batch.column("label").is_valid(), batch.column("vector").is_valid())))
            vectors = batch.column("vector")
            dims = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                flat = part.column("vector").flatten()
                whole = flat.is_valid().to_numpy(zero_copy_only=False).reshape(len(part), dim).all(1)
                with np.errstate(over="ignore", invalid="ignore"):
                    rows = np.floor(scale * flat.fill_null(0.0).to_numpy().reshape(len(part), dim))
                    whole &= np.isfinite(rows).all(1) & (np.sqrt((rows * rows).sum(1)) < LONGEST)
                rows = rows[whole].astype(np.int32)
                part = part.filter(pa.array(whole))
                ids, labels = (part.column(c).to_numpy() for c in ("id", "label"))
                asks = part.column("asks").fill_null(False).to_numpy(zero_copy_only=False)
                size = max(1, min(BLOCK_ROWS, BLOCK_BYTES // max(1, 4 * dim)))
                for i in range(0, len(rows), size):
                    block += 1
                    held = (a[i:i + size].tobytes() for a in (ids, labels, asks, rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block]), pa.array([dim], pa.int32()), *(pa.array([h]) for h in held)],
                        ["block", "dim", "ids", "labels", "asks", "rows"])

    return run


def _unpacked(batch: pa.RecordBatch) -> Iterator[tuple]:
    for block, dim, ids, labels, asks, rows in zip(*(batch.column(c).to_pylist() for c in (
            "block", "dim", "ids", "labels", "asks", "rows"))):
        ids = np.frombuffer(ids, np.int64)
        yield (dim, ids, np.frombuffer(labels, np.int64), np.frombuffer(asks, bool),
               np.frombuffer(rows, np.int32).reshape(len(ids), dim))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of rows, sums and sums of squares of each component, for each length of vectors."""
    found: dict[int, list] = {}
    for batch in batches:
        for dim, _, _, _, rows in _unpacked(batch):
            rows = rows.astype(float)
            old = found.setdefault(dim, [0, np.zeros(dim), np.zeros(dim)])
            found[dim] = [old[0] + len(rows), old[1] + rows.sum(0), old[2] + (rows * rows).sum(0)]
    for dim, (n, total, square) in found.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(dim, dim, np.int32)), pa.array(np.arange(dim, dtype=np.int32)),
             pa.array(np.full(dim, n, np.int64)), pa.array(total), pa.array(square)],
            ["dim", "component", "n", "total", "square"])


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for dim, ids, labels, asks, rows in _unpacked(batch):
            at = np.flatnonzero(asks)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at]), pa.array(labels[at]), pa.array(np.full(len(at), dim, np.int32)),
                 pa.array([rows[i].tobytes() for i in at.tolist()], pa.binary())], ["anchor", "label", "dim", "vector"])


def _thresholds(moments: dict[int, tuple], number: int, k: int):
    """Each window with the score at which it starts this round."""
    def start(vector: np.ndarray, lo: int, hi: int) -> float:
        n, mean, variance, _ = moments[len(vector)]
        centre, spread = float(vector @ mean), float(np.sqrt(vector**2 @ variance))
        if not spread:
            return float(lo)
        normal = NormalDist(centre, spread)
        share = 1 - normal.cdf(hi) + k * FIRST * GROWTH**number / n
        return max(float(lo), normal.inv_cdf(1 - share)) if share < 1 else float(lo)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.frombuffer(v, np.int32).astype(float) for v in batch.column("vector").to_pylist()]
            found = [[start(v, w["lo"], w["hi"]) for w in asked]
                     for v, asked in zip(vectors, batch.column("windows").to_pylist())]
            yield batch.append_column("at", pa.array(found, pa.list_(pa.float64())))

    return run


class _Held:
    """A block with its components in the common order, and the norms of the suffixes that start at each stretch."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, order: np.ndarray):
        self.ids, self.labels = ids, labels
        self.rows = rows[:, order].astype(np.int64)
        self.columns = np.ascontiguousarray(self.rows.T.astype(float))
        self.rest = suffix_norms(self.columns)


def suffix_norms(columns: np.ndarray) -> np.ndarray:
    """Norms of what remains of each column from the start of each stretch on; the last row is zero."""
    starts = range(0, len(columns), STRETCH)
    squares = [np.einsum("ij,ij->j", columns[s:s + STRETCH], columns[s:s + STRETCH]) for s in starts]
    squares.append(np.zeros(columns.shape[1]))
    return np.sqrt(np.cumsum(np.array(squares)[::-1], axis=0)[::-1])


class _Asked:
    """A batch of anchors, their windows, and the best rows found so far in the shard."""

    def __init__(self, asks: list[dict], order: np.ndarray, same: bool, k: int):
        self.same, self.k = same, k
        self.ids = np.array([a["anchor"] for a in asks])
        self.labels = np.array([a["label"] for a in asks])
        self.rows = np.stack([np.frombuffer(a["vector"], np.int32)[order] for a in asks]).astype(np.int64)
        self.vectors = self.rows.astype(float)
        self.rest = suffix_norms(np.ascontiguousarray(self.vectors.T))
        self.width = max(len(a["windows"]) for a in asks)
        self.lo = np.full((len(asks), self.width), MOST)
        self.hi = np.full((len(asks), self.width), LEAST)
        self.at = np.full((len(asks), self.width), np.inf)
        self.names = np.zeros((len(asks), self.width), np.int64)
        for i, ask in enumerate(asks):
            for j, (window, at) in enumerate(zip(ask["windows"], ask["at"])):
                self.lo[i, j], self.hi[i, j], self.names[i, j], self.at[i, j] = window["lo"], window["hi"], window["w"], at
        self.found = (np.empty(0, np.int64),) * 3

    def search(self, block: _Held) -> None:
        least, most = self.at.min(1), self.hi.max(1).astype(float)
        slack = SLACK * (1 + self.rest[0][:, None] * block.rest[0][None, :].max(initial=0))
        least, most = (least[:, None] - slack)[:, 0], (most[:, None] + slack)[:, 0]
        with np.errstate(divide="ignore"):
            reach = np.where(least > 0, self.rest / least, np.inf).max(1)
        # The index: how many stretches of each row it holds. Rows that reach a stretch come first.
        with np.errstate(invalid="ignore"):
            inside = ~(block.rest * reach[:, None] < 1)[:-1]
        depth = np.where(inside.all(0), len(inside), inside.argmin(0)) if len(inside) else np.zeros(len(block.ids), int)
        order = np.argsort(-depth, kind="stable")
        if least.min(initial=np.inf) > 0:
            order = order[depth[order] > 0]
        depth, columns, rest = depth[order], block.columns[:, order], block.rest[:, order]
        fits = (self.labels[:, None] == block.labels[order][None, :]) == self.same
        fits &= self.ids[:, None] != block.ids[order][None, :]
        partial = np.zeros(fits.shape)
        for number in range(len(inside)):
            n = int(np.searchsorted(-depth, -number))
            begin = number * STRETCH
            partial[:, :n] += self.vectors[:, begin:begin + STRETCH] @ columns[begin:begin + STRETCH, :n]
            left = self.rest[number + 1][:, None] * rest[number + 1][None, :n]
            fits[:, :n] &= (partial[:, :n] + left >= least[:, None]) & (partial[:, :n] - left <= most[:, None])
            if np.count_nonzero(fits) * STRETCH < fits.size:
                break
        a, b = np.nonzero(fits)
        for i in range(0, len(a), PAIRS):
            self._add(block, a[i:i + PAIRS], order[b[i:i + PAIRS]], least)

    def _add(self, block: _Held, a: np.ndarray, b: np.ndarray, least: np.ndarray) -> None:
        """Scores of pairs in full; each goes to the windows it lies in, of which the best ``k`` stay."""
        score = np.einsum("ij,ij->i", self.rows[a], block.rows[b])
        pair, window = np.nonzero((score[:, None] >= self.at[a]) & (score[:, None] >= self.lo[a])
                                  & (score[:, None] <= self.hi[a]))
        if not len(pair):
            return
        key = np.concatenate([self.found[0], a[pair] * self.width + window])
        score = np.concatenate([self.found[1], score[pair]])
        ids = np.concatenate([self.found[2], block.ids[b[pair]]])
        order = np.lexsort((ids, -score, key))
        key, score, ids = key[order], score[order], ids[order]
        first = np.searchsorted(key, key)
        place = np.arange(len(key)) - first
        stay = place < self.k
        full = key[place == self.k - 1], score[place == self.k - 1]
        at = self.at.reshape(-1)
        at[full[0]] = np.maximum(at[full[0]], full[1])
        self.found = key[stay], score[stay], ids[stay]

    def results(self) -> pa.RecordBatch:
        key, score, ids = self.found
        ask, window = np.divmod(key, self.width)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[ask]), pa.array(self.names[ask, window]), pa.array(score), pa.array(ids)],
            ["anchor", "w", "score", "id"])


def _searched(orders: dict[int, np.ndarray], same: bool, k: int):
    """Blocks of a shard first, then the anchors that ask; the best rows of each window in the shard."""
    def asked(asks: list[dict], blocks: list[_Held]) -> Iterator[pa.RecordBatch]:
        if asks and blocks:
            batch = _Asked(asks, orders[asks[0]["dim"]], same, k)
            for block in blocks:
                batch.search(block)
            yield batch.results()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blocks, asks = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["shard"], row["dim"]) != now:
                    yield from asked(asks, blocks)
                    now, blocks, asks = (row["shard"], row["dim"]), [], []
                if row["rows"] is not None:
                    ids = np.frombuffer(row["ids"], np.int64)
                    blocks.append(_Held(ids, np.frombuffer(row["labels"], np.int64), np.frombuffer(
                        row["rows"], np.int32).reshape(len(ids), row["dim"]), orders[row["dim"]]))
                    continue
                asks.append(row)
                if len(asks) == BATCH:
                    yield from asked(asks, blocks)
                    asks = []
        yield from asked(asks, blocks)

    return run


class _Rows:
    """The packed rows and what all rounds share."""

    def __init__(self, blocks: DataFrame, folder: str):
        self.blocks, self.folder, self.rounds = blocks, folder, count()
        self.spark = blocks.sparkSession
        # One row per component and length of vectors.
        sums = blocks.mapInArrow(_moments, "dim int, component int, n bigint, total double, square double").groupBy(
            "dim", "component").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("square").alias("square"))
        self.moments, self.bytes = {0: (1, np.zeros(0), np.zeros(0), np.zeros(0, int))}, 0
        by_dim: dict[int, list] = {}
        for row in sums.orderBy("dim", "component").collect():
            by_dim.setdefault(row["dim"], []).append(row)
        for dim, rows in by_dim.items():
            n = rows[0]["n"]
            mean, square = (np.array([r[c] for r in rows]) / n for c in ("total", "square"))
            self.moments[dim] = n, mean, np.maximum(square - mean**2, 0), np.argsort(-square, kind="stable")
            self.bytes += 4 * n * dim
        self.shards = max(-(-self.bytes // SHARD_BYTES), self.spark.sparkContext.defaultParallelism)

    def best(self, anchors: DataFrame, windows: DataFrame, same: bool, k: int) -> DataFrame:
        """``(anchor, w, score, id, rank)``: the ``k`` best rows of each window ``(anchor, w, lo, hi)``.

        A round keeps what its filled windows found; a window that is not filled at its lower limit has no more rows.
        """
        found = []
        while True:
            number = next(self.rounds)
            asked = anchors.join(windows.groupBy("anchor").agg(F.collect_list(F.struct("w", "lo", "hi")).alias("windows")),
                                 "anchor")
            schema = f"{_ASKS}, windows array<struct<w: bigint, lo: bigint, hi: bigint>>, at array<double>"
            asked = written(asked.select(*anchors.columns, "windows").mapInArrow(
                _thresholds(self.moments, len(found), k), schema), f"{self.folder}/asked-{number}")
            hits = self._hits(asked, same, k)
            order = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "id")
            best = written(hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k),
                           f"{self.folder}/best-{number}")
            each = asked.select("anchor", F.inline(F.arrays_zip("windows", "at"))).select("anchor", "windows.*", "at")
            full = best.where(F.col("rank") == k).select("anchor", "w")
            windows = written(each.where(F.col("at") > F.col("lo").cast("double")).join(full, ["anchor", "w"], "left_anti")
                              .select("anchor", "w", "lo", "hi"), f"{self.folder}/windows-{number}")
            found.append(best.join(windows, ["anchor", "w"], "left_anti"))
            removed(self.spark, f"{self.folder}/asked-{number}")
            if windows.isEmpty():
                break
        whole = found[0]
        for more in found[1:]:
            whole = whole.unionByName(more)
        return whole

    def _hits(self, asked: DataFrame, same: bool, k: int) -> DataFrame:
        low = F.col("block").bitwiseAND(F.lit((1 << 32) - 1))
        shard = F.pmod(F.shiftright("block", 32) + low, F.lit(self.shards)).cast("int")
        rows = self.blocks.select(shard.alias("shard"), "dim", "ids", "labels", "rows")
        asks = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(self.shards - 1))))
        both = rows.unionByName(asks, allowMissingColumns=True)
        placed = both.repartitionById(self.shards, "shard").sortWithinPartitions(
            "shard", "dim", F.col("rows").isNull(), "anchor")
        orders = {dim: found[3] for dim, found in self.moments.items()}
        return placed.mapInArrow(_searched(orders, same, k), "anchor bigint, w bigint, score bigint, id bigint")


def hard_negatives(vectors: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding",
                   label: str = "label", positives: int = 5, negatives: int = 5, least: tuple[int, int] = (80, 100),
                   scale: float = 256.0) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows where ``anchors`` holds.

    Components become ``floor(scale * x)``; a score is the inner product with the anchor. Its positives are the
    ``positives`` best other rows of its label; for each of them the ``negatives`` best rows of other labels
    are given whose score is at most the positive's and at least ``least[0] / least[1]`` of it, ranked from
    1. Higher scores come first, ties by smaller key. A negative positive score admits no row.

    Rows with a NULL key, label or vector, with a NULL or non-finite component, or with an integer norm of 2^31 or more (whose
    scores would leave 64 bits) take no part. Only vectors of equal length are
    compared; empty ones score 0. Rows that share an anchor's key are neither its positives nor its negatives; of several
    such anchors the one with the smallest label and vector asks. Other repeated rows count as rows each.
    Other columns are ignored; an empty table gives an empty result. Keys and labels must be integers.
    """
    spark = vectors.sparkSession
    folder = scratch(spark, "negatives")
    rows = vectors.select(
        F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{label}`").cast("bigint").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"), anchors.alias("asks"))
    blocks = written(rows.mapInArrow(_blocks(scale), _BLOCKS), f"{folder}/blocks")
    held = _Rows(blocks, folder)
    first = Window.partitionBy("anchor").orderBy("label", "vector")
    asks = written(blocks.mapInArrow(_anchors, _ASKS).withColumn("place", F.row_number().over(first))
                   .where("place = 1").drop("place"), f"{folder}/anchors")
    open_ended = asks.select("anchor", F.lit(0).cast("bigint").alias("w"), F.lit(LEAST).alias("lo"), F.lit(MOST).alias("hi"))
    near = held.best(asks, open_ended, True, positives).select(
        "anchor", F.col("rank").cast("bigint").alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    near = written(near, f"{folder}/positives")
    lo = F.expr(f"({least[0]}BD * positive_score + {least[1] - 1}BD) div {least[1]}BD")
    windows = near.where("positive_score >= 0").select("anchor", "w", lo.alias("lo"), F.col("positive_score").alias("hi"))
    found = held.best(asks, windows, False, negatives)
    return found.join(near, ["anchor", "w"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
