"""Bloom filters over a key column, built and probed with built-in functions.

For key sets too large to broadcast as they are: a filter takes about ten bits a key, whatever
the key's width, so the rows whose key is surely absent leave a large table inside its scan
stage, before anything is shuffled. The few that pass by chance are left to the exact join after it.

The filter is split into blocks of 512 bits, eight longs. A key has one block and one
bit in each of its longs, all taken from two 64-bit hashes, so a block is built by bitwise
ORs (merged map-side, repeated keys do not matter) and a probe is one
broadcast hash join on the block number with eight bit tests, in one stage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
BLOCK_BITS = 64 * WORDS
# a row of the broadcast table: null bits, block number, eight longs, and its place in the hash table
BLOCK_BYTES = 8 + 8 + 8 * WORDS + 32
# below this many bits a key, too many absent keys pass (a tenth at six bits)
LEAST_BITS = 6
MOST_BITS = 16


def block_count(n_keys: int, budget: int) -> int:
    """Blocks of a filter of up to n_keys distinct keys that fits `budget` bytes, at most
    MOST_BITS a key; 0 where that leaves fewer than LEAST_BITS a key."""
    blocks = min(budget // BLOCK_BYTES, -(-max(n_keys, 1) * MOST_BITS // BLOCK_BITS))
    return blocks if blocks * BLOCK_BITS >= LEAST_BITS * n_keys else 0


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), key), F.lit(blocks))


def _bits(h: Column) -> list[Column]:
    """The bit of each long of a key's block, as a mask."""
    place = [F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), p) for p in place]


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(_block, _w0 .. _w7): the blocks that keys of the column fall into."""
    placed = keys.select(_block(F.col(key), blocks).alias("_block"), F.xxhash64(F.lit(2), F.col(key)).alias("_h"))
    return placed.groupBy("_block").agg(*[F.bit_or(m).alias(f"_w{i}") for i, m in enumerate(_bits(F.col("_h")))])


def may_match(df: DataFrame, key: str, filter_: DataFrame, blocks: int) -> DataFrame:
    """Rows of df whose key may be in the filter: all whose key is, and a few others."""
    probe = [(F.col(f"_w{i}").bitwiseAND(m)) != 0 for i, m in enumerate(_bits(F.xxhash64(F.lit(2), df[key])))]
    hit = reduce(lambda a, b: a & b, probe, _block(df[key], blocks) == F.col("_block"))
    return df.join(F.broadcast(filter_), hit, "left_semi")
