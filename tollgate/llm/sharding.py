"""Shard placement by a permutation-filled lookup table (Maglev hashing).

Each shard prefers the slots of a prime-sized table in its own order, a permutation
drawn from its name; shards take turns claiming their next free slot until the table is
full. Every shard gets the same number of slots within one (or its weight's share), and
when a shard leaves, few slots change hands between the shards that stay. A row's shard is
the slot of its key's hash: one lookup in a table of fixed size.

Defined results: a null key has a slot like any other value; equal keys share a shard;
an empty table stays empty; all columns of the input are kept, and a column that already
has the name of the output column is an error.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import unused

MAX_SLOTS = 1 << 20  # the table is broadcast: at most 16 MB


def _draw(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def fill_table(shards: list[str], slots: int, weights: dict[str, int] | None = None) -> np.ndarray:
    """Index of the owning shard per slot. `slots` must be prime, so that every stride
    walks the whole table. A shard of weight w takes w turns in each round."""
    if slots > MAX_SLOTS or slots < max(2, len(shards)) or any(slots % d == 0 for d in range(2, int(slots ** 0.5) + 1)):
        raise ValueError(f"slots must be a prime of at least the number of shards and at most {MAX_SLOTS}")
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names")
    offset = [_draw(s, "offset") % slots for s in shards]
    stride = [1 + _draw(s, "stride") % (slots - 1) for s in shards]
    turns = [i for i, s in enumerate(shards) for _ in range((weights or {}).get(s, 1))]
    table, tried, free = np.full(slots, -1, dtype=np.int32), [0] * len(shards), slots
    while free:
        for i in turns:
            while True:
                slot = (offset[i] + tried[i] * stride[i]) % slots
                tried[i] += 1
                if table[slot] < 0:
                    break
            table[slot] = i
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def place(df: DataFrame, key: str, shards: list[str], slots: int = 65537,
          weights: dict[str, int] | None = None, name: str = "shard") -> DataFrame:
    """`df` plus its shard's name. The table has `slots` rows whatever the size of `df`,
    so it is broadcast and no row of `df` is shuffled."""
    if name in df.columns:
        raise ValueError(f"the input already has a column {name!r}")
    table = fill_table(shards, slots, weights)
    slot = unused("_slot", [*df.columns, name])
    rows = df.sparkSession.createDataFrame(
        [(i, shards[s]) for i, s in enumerate(table.tolist())], f"{slot} int, `{name}` string")
    return (df.withColumn(slot, slot_of(F.col(key), slots))
            .join(F.broadcast(rows), slot).drop(slot))


def write_sharded(df: DataFrame, path: str, tasks: int, name: str = "shard") -> None:
    """One folder per shard. Rows are dealt to tasks round robin, so a shard with a hot
    key is written by all of them."""
    df.repartition(tasks).write.partitionBy(name).parquet(path)
