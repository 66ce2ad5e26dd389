"""Exact duplicates by deterministic block naming.

Texts are cut into blocks of fixed size. Blocks are sorted, and each distinct one gets an
integer name; then adjacent names are paired, the pairs sorted and named in turn, until one name
is left of each text. After equally many rounds, equal names mean equal texts and nothing else: no
hash decides. Texts are dealt to chunks of bounded size. A chunk brings each of its distinct
blocks, pairs or identities once, whatever number of its texts hold it, and gets the names back
by its own number, so a block in a third of all rows is no hot key.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import pieces, removed, scratch, written
from .words import utf8

BLOCK = 1024
CHUNK = 8 << 20
NONE = -1
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
#: One more than the largest long, and a key below all longs for rows without one.
_SHIFT = "10000000000000000000"
_NO_KEY = "-9223372036854775809"

_LEFT = "chunk bigint, at binary, sizes binary, codes binary"
_CHUNKS = ["chunk", "ids", "digests", "at", "sizes", "codes", "local", "block"]


def _blocks(size: int, limit: int):
    """A row per chunk: keys and digests of its texts, and each text as places among the distinct blocks; a row per such block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, part in enumerate(pieces(batches, "text", limit)):
            raw, bounds = utf8(part.column("text"))
            text = _LOWER[raw].tobytes()
            places: dict[bytes, int] = {}
            digests, sizes, codes = [], [], []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                digests.append(sha256(memoryview(text)[a:b]).digest())
                starts = range(a, max(b, a + 1), size)
                sizes.append(len(starts))
                codes += [places.setdefault(text[i:min(i + size, b)], len(places)) for i in starts]
            chunk = (task << 32) + number
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk]), _one(part.column("id"), pa.list_(pa.int64())), pa.array([b"".join(digests)]),
                 *_packed(np.arange(len(sizes)), sizes, codes), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary())],
                _CHUNKS)
            blocks, n = list(places), len(places)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, chunk)), pa.nulls(n, pa.list_(pa.int64())), *(pa.nulls(n, pa.binary()) for _ in range(4)),
                 pa.array(np.arange(n, dtype=np.int32)), pa.array(blocks, pa.binary())], _CHUNKS)

    return run


def _one(values: pa.Array, kind: pa.DataType) -> pa.Array:
    """A column of one row that holds the list of ``values``."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values).cast(kind)


def _packed(*numbers) -> list[pa.Array]:
    return [pa.array([np.asarray(n, np.int32).tobytes()]) for n in numbers]


def _ints(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_py(), np.int32)


def _numbered(columns: list[str]):
    """The name of each row: the number of its task, then its place among the distinct sorted values there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, last = (TaskContext.get().partitionId() << 40) - 1, None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            for column in (batch.column(c) for c in columns):
                new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            first = [batch.column(c)[0] for c in columns]
            new[0] = first != last
            last = [batch.column(c)[-1] for c in columns]
            names = name + np.cumsum(new)
            name = int(names[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("chunk"), batch.column("local"), pa.array(names)], ["chunk", "local", "name"])

    return run


def _named(keys: DataFrame, columns: list[str]) -> DataFrame:
    """``(chunk, named)``: the names of the values of each chunk, in the order of their places."""
    ordered = keys.repartition(*columns).sortWithinPartitions(*columns)
    names = ordered.mapInArrow(_numbered(columns), "chunk bigint, local int, name bigint")
    return _by_chunk(names, "name")


def _by_chunk(rows: DataFrame, *columns: str) -> DataFrame:
    """One row per chunk with its values in the order of ``local``; a chunk has a bounded number of them."""
    held = F.sort_array(F.collect_list(F.struct("local", *columns)))
    return rows.groupBy("chunk").agg(held.alias("named"))


def _halved(names: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adjacent names of each text as pairs; a last one alone is paired with ``NONE``."""
    half = (sizes + 1) // 2
    first = np.cumsum(sizes) - sizes
    place = np.arange(half.sum()) - np.repeat(np.cumsum(half) - half, half)
    left = np.repeat(first, half) + 2 * place
    alone = 2 * place + 1 == np.repeat(sizes, half)
    right = names[np.minimum(left + 1, len(names) - 1)]
    right[alone] = NONE
    return names[left], right, half


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of one name are done; of the others, the distinct pairs of the chunk and each text as places among them."""
    for batch in batches:
        for row in range(batch.num_rows):
            names = batch.column("named")[row].values.field("name").to_numpy()
            at, sizes, codes = (_ints(batch.column(c)[row]) for c in ("at", "sizes", "codes"))
            names = names[codes]
            done = sizes == 1
            ends = names[(np.cumsum(sizes) - 1)[done]]
            names, at, over, sizes = names[np.repeat(~done, sizes)], at[~done], at[done], sizes[~done]
            if len(at):
                left, right, sizes = _halved(names, sizes)
                lefts, i = np.unique(left, return_inverse=True)
                rights, j = np.unique(right, return_inverse=True)
                pairs, codes = np.unique(i * len(rights) + j, return_inverse=True)
                left, right = lefts[pairs // len(rights)], rights[pairs % len(rights)]
            else:
                left = right = np.empty(0, np.int64)
                codes = np.empty(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("chunk").slice(row, 1), *_packed(at, sizes, codes),
                 _one(pa.array(left), pa.list_(pa.int64())), _one(pa.array(right), pa.list_(pa.int64())),
                 *_packed(over), pa.array([ends.tobytes()])],
                ["chunk", "at", "sizes", "codes", "left", "right", "done", "ends"])


def _identities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct identities of a chunk, with the number of texts, the largest key and the first row that has it."""
    for batch in batches:
        for row in range(batch.num_rows):
            ids = batch.column("ids")[row].values
            rounds, names = np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
            for number, done, ends in zip(*(batch.column("results")[row].values.field(i).to_pylist() for i in range(3))):
                done = np.frombuffer(done, np.int32)
                rounds[done], names[done] = number, np.frombuffer(ends, np.int64)
            order = np.lexsort((names, rounds))
            new = np.ones(len(ids), bool)
            new[1:] = (np.diff(names[order]) != 0) | (np.diff(rounds[order]) != 0)
            codes = np.empty(len(ids), np.int32)
            codes[order] = np.cumsum(new) - 1
            there = ids.is_valid().to_numpy(zero_copy_only=False)
            key = ids.fill_null(0).to_numpy()
            best = np.lexsort((-np.arange(len(ids)), key, there, codes))
            best = best[np.append(np.diff(codes[best]) != 0, True)]
            one = order[new]
            yield pa.RecordBatch.from_arrays(
                [batch.column("chunk").slice(row, 1), *_packed(codes, best),
                 _one(pa.array(rounds[one]), pa.list_(pa.int64())), _one(pa.array(names[one]), pa.list_(pa.int64())),
                 _one(ids.take(pa.array(best)), pa.list_(pa.int64())),
                 _one(pa.array(np.bincount(codes)), pa.list_(pa.int64()))],
                ["chunk", "codes", "best", "round", "name", "top", "n"])


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            ids = batch.column("ids")[row].values
            codes, best = (_ints(batch.column(c)[row]) for c in ("codes", "best"))
            named = batch.column("named")[row].values
            kept = np.zeros(len(ids), bool)
            kept[best[named.field("holder").to_numpy() == batch.column("chunk")[row].as_py()]] = True
            digests = batch.column("digests")[row].as_py().hex()
            places = pa.array(codes)
            yield pa.RecordBatch.from_arrays(
                [ids, named.field("keep").take(places), named.field("size").take(places), pa.array(kept),
                 pa.array([digests[i:i + 64] for i in range(0, len(digests), 64)], pa.string())],
                ["id", "keep_id", "group_size", "kept", "text_sha256"])


def _weight(key: Column, chunk: Column) -> Column:
    """Key and chunk as one number that grows with the key, then falls with the chunk."""
    whole = F.coalesce(key.cast("decimal(19,0)"), F.lit(_NO_KEY).cast("decimal(19,0)"))
    return (whole * F.lit(_SHIFT).cast("decimal(20,0)") - chunk.cast("decimal(19,0)")).cast("decimal(38,0)")


def _holder(weight: Column) -> tuple[Column, Column]:
    """Key and chunk of a weight."""
    up = F.ceil(weight / F.lit(_SHIFT).cast("decimal(20,0)"))
    chunk = up.cast("decimal(19,0)") * F.lit(_SHIFT).cast("decimal(20,0)") - weight
    none = up == F.lit(_NO_KEY).cast("decimal(19,0)")
    return F.when(~none, up).cast("bigint"), chunk.cast("bigint")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = BLOCK,
                 chunk: int = CHUNK) -> DataFrame:
    """One row per document: ``key``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are identical after lower-casing A-Z; NULL counts as empty, and
    empty texts are equal to one another. ``keep_id`` is the largest key of the group. Exactly one
    row of a group is kept: the one with that key, the first written of several. A NULL key is smaller than
    all others; where a group has no other, ``keep_id`` is NULL. Other columns are ignored; an empty
    table gives an empty result. Keys must be integers. ``size`` is the number of bytes of a block,
    ``chunk`` the number of bytes of texts named together; a longer text is a chunk by itself.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "naming")
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    base = written(rows.mapInArrow(_blocks(size, chunk), "chunk bigint, ids array<bigint>, digests binary, at binary, "
                                   "sizes binary, codes binary, local int, block binary"), f"{folder}/blocks")
    state, results, number = base.where("local IS NULL"), None, 0
    whole = written(state.select("chunk", "ids", "digests"), f"{folder}/keys")
    names = _named(base.where("local IS NOT NULL").select("chunk", "local", "block"), ["block"])
    while True:
        state = written(state.select("chunk", "at", "sizes", "codes").join(names, "chunk").mapInArrow(
            _paired, f"{_LEFT}, left array<bigint>, right array<bigint>, done binary, ends binary"),
            f"{folder}/round-{number}")
        found = state.select("chunk", F.struct(F.lit(number).alias("round"), "done", "ends").alias("result"))
        results = found if results is None else results.unionByName(found)
        state = state.where(F.size("left") > 0)
        if number == 0:
            removed(spark, f"{folder}/blocks")
        if state.isEmpty():
            break
        number += 1
        pairs = state.select("chunk", F.posexplode(F.arrays_zip("left", "right")).alias("local", "pair"))
        names = _named(pairs.select("chunk", "local", "pair.left", "pair.right"), ["left", "right"])

    held = results.groupBy("chunk").agg(F.collect_list("result").alias("results"))
    local = written(whole.select("chunk", "ids").join(held, "chunk").mapInArrow(
        _identities, "chunk bigint, codes binary, best binary, round array<bigint>, name array<bigint>, "
        "top array<bigint>, n array<bigint>"), f"{folder}/identities")
    for done in range(number + 1):
        removed(spark, f"{folder}/round-{done}")
    each = local.select("chunk", F.posexplode(F.arrays_zip("round", "name", "top", "n")).alias("local", "its")).select(
        "chunk", "local", "its.*")
    keep, holder = _holder(F.col("weight"))
    groups = each.groupBy("round", "name").agg(
        F.max(_weight(F.col("top"), F.col("chunk"))).alias("weight"), F.sum("n").alias("size")).select(
        "round", "name", keep.alias("keep"), holder.alias("holder"), "size")
    answers = _by_chunk(each.select("chunk", "local", "round", "name").join(groups, ["round", "name"]),
                        "keep", "holder", "size")
    found = whole.join(local.select("chunk", "codes", "best"), "chunk").join(
        answers, "chunk").mapInArrow(
        _answers, "id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string")
    return found.withColumnRenamed("id", key)
