"""The corpus pipeline: language ID, exact dedup, near dedup, mixing, tokenisation.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage before kept,
and returns a DataFrame that is written as Parquet and read again as the next one's docs. All
but the last return the columns of `documents`.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import byte_bpe, exact_dedup, language_id, mixing, near_dedup
from tollgate.llm.common import apply_copies, table, unused
from tollgate.plans.materialize import checkpoint_dir

# a text with a smaller part of its n-grams in any landmark resembles no learned language
MIN_KNOWN = 0.35


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which some learned language is recognised. A text without letters, or
    one that resembles no learned language, goes. Learns from rows that are not held out
    and name a language; where none does, only texts without letters go."""
    model = language_id.fit(docs.where(~language_id.held_out(F.col("doc_id"))), ["doc_id"])
    if model.languages:
        name = unused("_found", docs.columns)
        found = docs.withColumn(name, language_id.detector(spark, model)(F.col("text")))
        kept = found.where((F.col(name)["lang_pred"] != language_id.UNDETERMINED) & (F.col(name)["known"] >= MIN_KNOWN))
    else:
        kept = docs.where(F.col("text").rlike(r"\p{L}"))
    return kept.select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    decided = exact_dedup.exact_dedup(docs).withColumn("copies", F.col("kept").cast("int"))
    return apply_copies(docs, decided)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    decided = near_dedup.near_groups(docs).withColumn("copies", F.col("kept").cast("int"))
    return apply_copies(docs, decided)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return apply_copies(docs, mixing.mix(docs))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens, and whether the ids decode to the text."""
    return byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                           keep=("doc_id", "lang", "source"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", tokenize),
]

# string kernels, weighted sampling and BPE are beyond SQL; tests/llm has brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`. What the stages hand on is written below the shared
    checkpoint folder."""
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
