"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm import language_id, token_files, toxicity, whitening
from tollgate.llm.byte_bpe import round_trip
from tollgate.llm.collocations import phrases
from tollgate.llm.common import table
from tollgate.llm.exact_dedup import exact_dedup
from tollgate.llm.fingerprint import fingerprint_edits
from tollgate.llm.mixing import mix
from tollgate.llm.near_dedup import near_groups
from tollgate.llm.oracles import LLM_ORACLES
from tollgate.llm.secret_scan import scan_secrets, span_list
from tollgate.llm.sharding import place
from tollgate.llm.url_filter import judge_urls

SHARDS = [f"shard-{i:02d}" for i in range(16)]


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    doc_id = F.expr("try_cast(regexp_extract(url, '://[^/?#]*[^?#]*?/([0-9]+)', 1) as bigint)")
    blocked = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return pages.select("url", doc_id.alias("doc_id")).join(labels.select("doc_id", blocked.alias("blocked")), "doc_id")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's path holds the id of its document, whose labels say what to block."""
    pages = table(spark, sf_dir, "pages")
    return judge_urls(pages, labelled_urls(pages, table(spark, sf_dir, "labels")))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("hits", lambda h: h["kind"] < 3)

    def count(test):
        return F.size(F.filter("hits", test)).cast("bigint")

    return found.select(
        "doc_id", count(lambda h: h["kind"] == 0).alias("n_assign"), count(lambda h: h["kind"] == 1).alias("n_access"),
        count(lambda h: h["kind"] == 2).alias("n_hex"), F.sha2(span_list(base), 256).alias("base_sha256"),
        span_list(F.col("hits")).alias("spans"), count(lambda h: h["class"] == "live").alias("n_live"),
        count(lambda h: h["class"] == "example").alias("n_example"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placement of every document, and where it would go without the last shard."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return place(place(docs, "doc_id", SHARDS), "doc_id", SHARDS[:-1], name="shard_without_last")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels only tell toxic from clean: toxic documents are graded 1 or 2 by their
    density of words that toxic documents have."""
    docs = table(spark, sf_dir, "documents")
    sample = toxicity.labelled_sample(docs, table(spark, sf_dir, "labels"), "doc_id", "toxic")
    return toxicity.score(docs, toxicity.fit(toxicity.density_grades(sample)), ["doc_id"])


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                      public_tokenizers.PATTERN)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("row", "text_key")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """class_id: the id of the document of the group that stays."""
    return near_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", F.col("keep_id").alias("class_id"), "group_size", "kept")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    told = docs.withColumn("held_out", language_id.held_out(F.col("doc_id")))
    model = language_id.fit(told.where(~F.col("held_out")), ["doc_id"])
    return language_id.predict(told, model, ["doc_id", "held_out"])


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases(table(spark, sf_dir, "documents"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes to files, then reads starts, lengths and checksums back from them."""
    tokens = token_files.encode_to_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return token_files.ids_checksum(tokens, ["doc_id", "start", "n_tokens"])


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


__all__ = ["LLM_ORACLES", "LLM_QUERIES"]

LLM_QUERIES = {f.__name__: f for f in (
    op1_url_filter, op2_secret_scan, op3_sharding, op4_toxicity, op5_byte_bpe, op6_exact_dedup, op7_near_dedup,
    op8_mixing, op9_fingerprint, op10_language_id, op11_collocations, op12_token_files, op13_whitening)}
