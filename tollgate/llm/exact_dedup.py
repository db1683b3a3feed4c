"""Exact dedup by deterministic block naming.

Each normalised text is cut into blocks of a fixed size. All distinct blocks are sorted
and named by integers; then adjacent pairs of names are sorted and named, and so on until
each document has one name. Names at a level are one-to-one with what they name, so two
documents of as many blocks have the same last name exactly if their texts are equal: an
identity without collisions, at a cost that halves with every level.

Only distinct blocks move with their text, once, merged on the map side. The rows of
documents carry a 64-bit hash of each block; a hash stands for its block where the
grouping by block text shows that no other block shares it. Where some do (`collided`),
the rows with those hashes are joined by the block text itself.

Defined results: null texts equal empty ones; both have no blocks and identity (0, 0).
Repeated rows and rows of the same id are told apart by a row number fixed in a
checkpoint; exactly one row of a group stays, the one of the largest id (null ids are
smallest, and of several rows with that id the first read stays). Only the id and text
columns are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import lower_ascii, text_of
from tollgate.plans.materialize import materialize

BLOCK_CHARS = 1024


def blocks_of(text: Column, block_chars: int) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % block_chars), F.lit(0))


def name_sorted(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """`distinct` plus `name`: rows are sorted by `keys` within each task and numbered;
    the checkpoint fixes the numbers."""
    return materialize(distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())
                       .select(*[c for c in distinct.columns if c != "block"], "name"))


def name_blocks(texts: DataFrame, rows: DataFrame, block_chars: int, block_hash: Callable[[Column], Column]) -> DataFrame:
    """Names of the blocks of `rows` (row, hashes): (row, pos, name)."""
    blocks = texts.select(F.explode(blocks_of(F.col("norm"), block_chars)).alias("block")).select(
        block_hash(F.col("block")).alias("h"), "block")
    named = name_sorted(blocks.distinct(), ["block"])
    per_hash = named.groupBy("h").agg(F.max("name").alias("name"), F.count("*").alias("n"))
    per_hash = materialize(per_hash)
    parts = rows.select("row", F.posexplode("hashes").alias("pos", "h"))
    out = parts.join(per_hash.where("n = 1").drop("n"), "h").select("row", "pos", "name")
    collided = per_hash.where("n > 1").select("h")
    if collided.isEmpty():
        return out
    # blocks whose hash another block has: exact names, below zero, by block text
    clash = materialize(blocks.join(collided, "h", "left_semi").select("block").distinct()
                        .sortWithinPartitions("block").withColumn("name", -1 - F.monotonically_increasing_id()))
    exact = (texts.select("row", F.posexplode(blocks_of(F.col("norm"), block_chars)).alias("pos", "block"))
             .withColumn("h", block_hash(F.col("block"))).join(collided, "h", "left_semi")
             .join(clash, "block").select("row", "pos", "name"))
    return out.unionByName(exact)


def name_pairs(names: DataFrame) -> DataFrame:
    """One level up: (row, pos, name) of adjacent pairs; an odd last name pairs with null."""
    pairs = names.groupBy("row", F.expr("pos div 2").cast("int").alias("pos")).agg(
        F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("l"),
        F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("r"))
    pairs = materialize(pairs)
    named = name_sorted(pairs.select("l", "r").distinct(), ["l", "r"])
    return pairs.join(named, (pairs["l"] == named["l"]) & pairs["r"].eqNullSafe(named["r"])).select(
        "row", "pos", "name")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS,
             normalise: Callable[[Column], Column] = lower_ascii,
             block_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per document: row, id, text_key (64-bit hash of the text as it is), text_sha256
    (of the normalised text), n_blocks and name; (n_blocks, name) is its identity."""
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col),
                        F.xxhash64(text_of(text_col)).alias("text_key"), normalise(text_of(text_col)).alias("norm"))
    hashes = F.transform(blocks_of(F.col("norm"), block_chars), lambda b: block_hash(b))
    rows = materialize(texts.select("row", id_col, "text_key", F.sha2("norm", 256).alias("text_sha256"), hashes.alias("hashes"))
                       .withColumn("n_blocks", F.size("hashes")))
    names = name_blocks(texts, rows, block_chars, block_hash)
    sizes = rows.select("row", "n_blocks")
    ended, level = [], 1
    most = rows.agg(F.max("n_blocks")).first()[0] or 0
    left = materialize(names.join(sizes, "row"))
    while most:
        ended.append(left.where(F.col("n_blocks") <= level).select("row", "name"))
        if level >= most:
            break
        longer = left.where(F.col("n_blocks") > level)
        left = materialize(name_pairs(longer.select("row", "pos", "name")).join(sizes, "row"))
        level *= 2
    done = rows.select("row", id_col, "text_key", "text_sha256", "n_blocks")
    if not ended:
        return done.withColumn("name", F.lit(0).cast("bigint"))
    identity = ended[0]
    for more in ended[1:]:
        identity = identity.unionByName(more)
    return done.join(identity, "row", "left").withColumn("name", F.coalesce("name", F.lit(0).cast("bigint")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document, dropped ones too: row, id, text_key, keep_id, group_size, kept
    and text_sha256. Of equal texts the row with the largest id stays."""
    identified = materialize(identify(docs, id_col, text_col, **options))
    groups = materialize(identified.groupBy("n_blocks", "name").agg(
        F.max(F.struct(F.col(id_col).alias("id"), (-F.col("row")).alias("first"))).alias("keep"),
        F.count("*").alias("group_size")))  # on its own, so that a join with a large group can split
    return identified.join(groups, ["n_blocks", "name"]).select(
        "row", id_col, "text_key", F.col("keep.id").alias("keep_id"), "group_size",
        (F.col("row") == -F.col("keep.first")).alias("kept"), "text_sha256")
