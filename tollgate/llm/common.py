"""Small helpers the operators share."""

from __future__ import annotations

import ctypes
import string
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.operators.joins import fits_broadcast
from tollgate.plans.materialize import materialize

DECISION_BYTES = 128  # of a decision in a broadcast table
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def give_back() -> None:
    """Freed memory of this worker to the system: Spark keeps the worker for later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`run` over batches, after which the worker gives freed memory back."""
    def inner(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return inner


def tidy_group(run: Callable[[pd.DataFrame], pd.DataFrame], rows: int = 256) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """`run` over a group, after which the worker gives freed memory back where the group had
    `rows` or more (a small one frees little, and there may be very many)."""
    def inner(frame: pd.DataFrame) -> pd.DataFrame:
        try:
            return run(frame)
        finally:
            if len(frame) >= rows:
                give_back()

    return inner


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to the Python workers a thousand rows at a time. Spark's 10,000 take tens of MB a
    batch, on both sides, and the JVM keeps its part for the later stages. A session's own number stays."""
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column = "text") -> Column:
    """The text, empty where null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def unused(name: str, columns) -> str:
    """`name`, with underscores added until no column has it (names match in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else. `lower` does just that on pure ASCII text and has
    a fast path for it; other texts take the slower character map."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def hash_fraction(*columns: str | Column, seed: int = 0) -> Column:
    """A repeatable number in [0, 1) from the columns' values."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 52)) / F.lit(float(1 << 52))


def apply_copies(docs: DataFrame, decided: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` as often as decided, with their own columns.

    `decided` has a row (id, text_key, copies) for every row of `docs`, in any order;
    text_key is xxhash64 of the text (empty for null). Rows that share both are
    interchangeable: one of them stands for the sum of their copies. Only decisions other
    than to take a single row once move; they are broadcast where their checked number
    allows it, else both sides are shuffled.
    """
    own = set(docs.columns)
    key, many, nth, id_name, key_name = (unused(c, own) for c in ("_key", "_copies", "_n", "_id", "_decided_key"))
    keyed = materialize(decided.groupBy(F.col(id_col).alias(id_name), F.col("text_key").alias(key_name)).agg(
        F.sum("copies").cast("int").alias(many), F.count("*").alias("_rows")))
    others = (F.col(many) != 1) | (F.col("_rows") > 1)
    facts = keyed.agg(F.count(F.when(others, 1)).alias("n"), F.max("_rows").alias("most")).first()
    side = keyed.where(others).drop("_rows")
    if fits_broadcast(facts["n"], DECISION_BYTES):
        side = F.broadcast(side)
    rows = docs.withColumn(key, F.xxhash64(text_of(text_col)))
    rows = rows.join(side, rows[id_col].eqNullSafe(side[id_name]) & (rows[key] == side[key_name]), "left")
    rows = rows.withColumn(many, F.coalesce(many, F.lit(1)))
    if (facts["most"] or 1) > 1:
        rows = rows.withColumn(nth, F.row_number().over(Window.partitionBy(id_col, key).orderBy(many))).where(F.col(nth) == 1)
    copied = rows.where(F.col(many) > 0).withColumn(nth, F.explode(F.sequence(F.lit(1), F.col(many))))
    return copied.select(*[F.col(f"`{c}`") for c in docs.columns])
