"""Placing rows on shards with a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size, a walk
from an offset by a fixed skip, both hashed from its name. Shards take turns, and each claims
the first free slot it prefers, until the table is full: slots are shared out evenly, and when
a shard comes or goes few of the others' slots change hands. A row's key is hashed to a slot,
so placing it is one lookup in a broadcast table whose size is a parameter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 65537


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def preference(name: str, slots: int) -> tuple[int, int]:
    """Offset and skip of a shard's walk; a skip below a prime meets every slot once."""
    digest = hashlib.blake2b(name.encode(), digest_size=16).digest()
    first, second = (int.from_bytes(digest[i:i + 8], "little") for i in (0, 8))
    return first % slots, second % (slots - 1) + 1


def lookup_table(shards: Sequence[str], slots: int = SLOTS, turns: Mapping[str, int] | None = None) -> np.ndarray:
    """The shard number of every slot. ``turns`` gives larger shards more turns a round (default 1)."""
    if not is_prime(slots):
        raise ValueError(f"the number of slots must be prime: {slots}")
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("shards must be named, distinct and no more than slots")
    walks = [preference(name, slots) for name in shards]
    rounds = [i for i, name in enumerate(shards) for _ in range((turns or {}).get(name, 1))]
    if not rounds:
        raise ValueError("no shard has a turn")
    table = np.full(slots, -1, np.int32)
    at = [offset for offset, _ in walks]
    left = slots
    while left:
        for i in rounds:
            slot, skip = at[i], walks[i][1]
            while table[slot] >= 0:
                slot = (slot + skip) % slots
            table[slot] = i
            at[i] = (slot + skip) % slots
            left -= 1
            if not left:
                break
    return table


def place(df: DataFrame, keys: Sequence[str], shards: Sequence[str], slots: int = SLOTS,
          turns: Mapping[str, int] | None = None) -> DataFrame:
    """All columns of ``df``, then ``slot`` and ``shard`` (a name out of ``shards``).

    Equal keys meet on one shard; for a key that holds a large share of all rows name further
    ``keys``, such as the row's id, and it is spread. NULL keys are hashed as any other value.
    Repeated rows stay; columns of ``df`` called ``slot`` or ``shard`` give way; an empty table
    gives an empty result.
    """
    spark = df.sparkSession
    table = lookup_table(shards, slots, turns)
    names = pa.array(shards).take(pa.array(table))
    slot_table = spark.createDataFrame(pa.table({"slot": np.arange(slots, dtype=np.int64), "shard": names}))
    slot = F.pmod(F.xxhash64(*(F.col(f"`{k}`") for k in keys)), F.lit(slots).cast("bigint"))
    rest = [c for c in df.columns if c not in ("slot", "shard")]
    rows = df.select(*(F.col(f"`{c}`") for c in rest), slot.alias("slot"))
    placed = rows.join(F.broadcast(slot_table), "slot")  # ``slots`` rows
    return placed.select(*(F.col(f"`{c}`") for c in rest), "slot", "shard")


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard; REBALANCE lets AQE cut a large shard into several files."""
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
