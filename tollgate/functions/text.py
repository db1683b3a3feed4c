"""Texts under a collation (the source database compares text case-insensitively and
ignores trailing blanks): join keys, DISTINCT and groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def collated(df: DataFrame, columns, collation: str | None = None) -> DataFrame:
    """df with those of its text columns that are named in `columns` compared under the
    collation: joins, groups and filters on them follow it."""
    names = set(text_columns(df)) & set(columns)
    if collation is None or not names:
        return df
    return df.select(*[F.collate(c, collation).alias(c) if c in names else F.col(c) for c in df.columns])


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def compares_binary(df: DataFrame, column: str) -> bool:
    """False where the column is a text under a collation: hashes of equal values may differ then."""
    kind = df.schema[column].dataType
    return not isinstance(kind, StringType) or kind == StringType()


def distinct_rows(df: DataFrame, collation: str | None = None) -> DataFrame:
    """df.distinct(); with a collation (e.g. 'UNICODE_CI_RTRIM') text columns
    compare under it, so 'abc' and 'ABC ' are one value. Of the rows that are equal under it the one
    whose spellings come first in binary order is kept, so reruns agree. The output
    columns are plain strings again."""
    text = text_columns(df)
    if collation is None or not text:
        return df.distinct()
    plain = F.struct(*[F.col(c).cast("string").alias(c) for c in text])
    named = {c: f"_group_{i}" for i, c in enumerate(df.columns)}
    keys = [(F.collate(F.col(c).cast("string"), collation) if c in text else F.col(c)).alias(named[c]) for c in df.columns]
    kept = df.groupBy(*keys).agg(F.min(plain).alias("_spelling"))
    return kept.select(*[F.col(f"_spelling.{c}") if c in text else F.col(named[c]).alias(c) for c in df.columns])
