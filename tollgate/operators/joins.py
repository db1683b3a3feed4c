"""Join helpers: broadcast only behind a proven size bound."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tollgate.functions.text import compares_binary
from tollgate.operators.bloom import block_count, bloom_filter, may_match

# A broadcast must fit this budget: checked rows x bytes per row. Above it the join is
# shuffled, and AQE may still switch it to a broadcast join at runtime from the
# measured size of the shuffled side.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# Row widths (UnsafeRow: 8-byte null bitmap word + 8 bytes per fixed-width field).
KEY_ROW_BYTES = 16     # one fixed-width key
WIDE_ROW_BYTES = 96    # a day, a currency and six decimal(18,6) rates
NAMED_ROW_BYTES = 64   # an id and a short name or a decimal
# Up to so many keys are pushed into a Parquet scan as values (session.py lets the reader
# take as many one by one), more as their range.
PUSHED_KEYS = 200


@dataclasses.dataclass(frozen=True)
class KeyBound:
    """Checked size of a key column: rows, and the bytes of its widest row."""

    rows: int
    row_bytes: int = KEY_ROW_BYTES

    @property
    def fits(self) -> bool:
        return fits_broadcast(self.rows, self.row_bytes)


def key_bounds(df: DataFrame, *keys: str) -> dict[str, KeyBound]:
    """The bound of each key column of df, in one pass: a count and, for text keys, the
    longest value (one row of numbers per task)."""
    text = [k for k in keys if isinstance(df.schema[k].dataType, StringType)]
    row = df.agg(F.count("*").alias("n"), *[F.max(F.octet_length(k)).alias(k) for k in text]).first()
    return {k: KeyBound(row["n"], KEY_ROW_BYTES + (8 + -(-(row[k] or 0) // 8) * 8 if k in text else 0)) for k in keys}


def fits_broadcast(bound_rows: int, row_bytes: int = KEY_ROW_BYTES) -> bool:
    return bound_rows * row_bytes <= BROADCAST_MAX_BYTES


def broadcast_if_bounded(df: DataFrame, bound_rows: int, row_bytes: int = KEY_ROW_BYTES) -> DataFrame:
    """Broadcast df when a proven row bound times the row width fits the budget."""
    return F.broadcast(df) if fits_broadcast(bound_rows, row_bytes) else df


def broadcast_checked(df: DataFrame, row_bytes: int = KEY_ROW_BYTES) -> DataFrame:
    """Broadcast a dimension after checking its row count against the budget for
    rows of this width; else leave it to the planner and AQE."""
    return broadcast_if_bounded(df, df.count(), row_bytes)


def semi_join_keys(df: DataFrame, keys: DataFrame, key: str, bound: KeyBound, budget: int | None = None) -> DataFrame:
    """Rows of df whose `key` occurs in `keys`, before anything else happens to them.

    `bound` is the checked size of the key column of `keys`. Within the broadcast budget
    the column is broadcast as it is (a semi join needs no distinct keys, so no
    shuffle builds it) and the other rows of df are dropped inside its scan stage. Beyond
    it, a Bloom filter of the keys, which is about ten times smaller than numbers and forty times
    smaller than text ids, drops nearly all of them there, and a shuffled semi join on the distinct
    keys the rest; beyond the filter's reach too, that join alone. The rows are the same.
    """
    budget = BROADCAST_MAX_BYTES if budget is None else budget
    if bound.rows * bound.row_bytes <= budget:
        return df.join(F.broadcast(keys.select(key)), key, "left_semi")
    blocks = block_count(bound.rows, budget)
    # a filter of hashes would drop values that only a collation makes equal
    if blocks and compares_binary(df, key) and compares_binary(keys, key):
        df = may_match(df, key, bloom_filter(keys, key, blocks), blocks)
    return df.join(keys.select(key).distinct(), key, "left_semi")


def stored_rows_of(df: DataFrame, keys: DataFrame, key: str, bound: KeyBound) -> DataFrame:
    """Rows of a stored table whose `key` occurs in `keys`, cut where the files are read.

    Parquet statistics, dictionaries and Bloom filters know predicates, not joins. Up to PUSHED_KEYS
    checked rows the keys themselves become the predicate, so row groups and pages without any of
    them are not read, and the predicate is exact. Beyond that the range of the keys is the
    predicate, and `semi_join_keys` drops what is left between them. Null keys match nothing."""
    if bound.rows <= PUSHED_KEYS:
        found = keys.select(key).where(F.col(key).isNotNull()).distinct().collect()
        return df.where(F.col(key).isin(sorted(r[0] for r in found)))
    ends = keys.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    return semi_join_keys(df.where(F.col(key).between(ends["lo"], ends["hi"])), keys, key, bound)


def row_lookup(df: DataFrame, *columns: str) -> dict:
    """Values of `columns` in a lookup that yields at most one row ({col: None, ...}
    for no row), in one small job.

    More than one row is ambiguous (the source engine would pick any row), so it
    is an error here. At most two rows reach the driver.
    """
    rows = df.select(*columns).limit(2).collect()
    if len(rows) > 1:
        raise ValueError(f"lookup of {columns!r} returned more than one row")
    return {c: (rows[0][c] if rows else None) for c in columns}


def scalar_lookup(df: DataFrame, column: str):
    """The value of one column in an at-most-one-row lookup (NULL for none)."""
    return row_lookup(df, column)[column]
