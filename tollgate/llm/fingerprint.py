r"""Document fingerprints: a Merkle tree over paragraphs and sections.

A text's paragraphs are its lines; a paragraph's leaves are pieces of at most 16 words
that also end where a sentence ends. A leaf's digest is that of its characters, a
paragraph's that of its leaves' digests, a section's that of its paragraphs' and the
root's that of the sections'. A section ends after a paragraph whose digest starts with 0,
1, 2 or 3: the content decides, so an edit moves no later section. Equal roots mean equal
texts; unequal ones are followed down to the sections and leaves that differ.

The fingerprint is one string: `root:sections:leaves`, sections joined by `,` and leaves by
`,` within a paragraph and `;` between paragraphs, each cut to 8 hex digits.

Defined results: a null text is an empty one; an empty text has one empty paragraph and a
fingerprint like any other. The next document is that of the next smaller id; rows of the
same id follow each other in the order of their texts' hashes (rows with equal ids and
texts are interchangeable), null ids come last, and the first document follows the last
one. Only the id and text columns are read.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollgate.llm.common import text_of

# words that don't end a sentence, then the word that ends the leaf; or leading blanks
LEAF = r"(?:[^ ]*[^ .!?] +){0,15}[^ ]+ *| +"
SHORT = 8


def with_fingerprint(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """`df` plus the fingerprint of `text_col`. The steps are columns of their own, so that
    no step is worked out twice; their names start with `_`."""
    leaves = F.transform(F.split(F.col(text_col), "\n", -1), lambda p: F.transform(
        F.regexp_extract_all(p, F.lit(LEAF), F.lit(0)), lambda leaf: F.md5(leaf)))
    paragraphs = F.transform("_leaves", lambda p: F.md5(F.array_join(p, ",")))
    marked = F.array_join(F.transform("_paragraphs", lambda d: F.concat(
        d, F.when(d < "4", "|").otherwise(";"))), "")
    sections = F.transform(F.split("_marked", r"\|", -1), lambda s: F.md5(s))

    def short(digests: Column) -> Column:
        return F.array_join(F.transform(digests, lambda d: F.substring(d, 1, SHORT)), ",")

    out = F.concat_ws(":", F.sha2(F.array_join("_sections", ","), 256), short(F.col("_sections")),
                      F.array_join(F.transform("_leaves", short), ";"))
    return (df.withColumn("_leaves", leaves).withColumn("_paragraphs", paragraphs).withColumn("_marked", marked)
            .withColumn("_sections", sections).withColumn(name, out)
            .drop("_leaves", "_paragraphs", "_marked", "_sections"))


def leaf_set(fingerprint: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.split_part(fingerprint, F.lit(":"), F.lit(3)), "[,;]"), lambda x: x != ""))


def section_list(fingerprint: Column) -> Column:
    return F.split(F.split_part(fingerprint, F.lit(":"), F.lit(2)), ",")


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else the share of leaves that both have (Dice), 0 to 1."""
    root_a, root_b = F.split_part(a, F.lit(":"), F.lit(1)), F.split_part(b, F.lit(":"), F.lit(1))
    leaves_a, leaves_b = leaf_set(a), leaf_set(b)
    both = F.size(F.array_intersect(leaves_a, leaves_b))
    total = F.size(leaves_a) + F.size(leaves_b)
    return F.when(root_a == root_b, 1.0).when(total == 0, 0.0).otherwise(2.0 * both / total)


def changed_sections(old: Column, new: Column) -> Column:
    """Positions (from 0) of the sections of `new` that `old` does not have."""
    before = section_list(old)
    return F.filter(F.transform(section_list(new), lambda s, i: F.when(~F.array_contains(before, s), i)),
                    lambda i: i.isNotNull())


def with_next(docs: DataFrame, id_col: str, columns: list[str], tie: Column, buckets: int) -> DataFrame:
    """`docs` plus, for each of `columns`, `next_<column>`: its value in the next row in
    descending order of the id (after the last: the first).

    The texts move once, to buckets of neighbouring ids, whose bounds come from the ids'
    quantiles. Each bucket also gets the first row of the bucket that follows it, so a
    window within the bucket finds every next row; that copy is dropped afterwards.
    """
    key = F.col(id_col).cast("double")
    share = [i / buckets for i in range(1, buckets)]
    cuts = docs.select((-key).alias("_k")).approxQuantile("_k", share, 0.2 / buckets) if share else []
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    ranked = docs.withColumn("_k", -key).withColumn("_tie", tie)
    last = len(splits) - 1  # null ids: a bucket of their own, the last
    if len(splits) > 2:
        ranked = Bucketizer(splits=splits, inputCol="_k", outputCol="_b", handleInvalid="keep").transform(ranked)
    else:
        ranked = ranked.withColumn("_b", F.when(F.col("_k").isNull(), 1.0).otherwise(0.0))
    ranked = ranked.withColumn("_b", F.coalesce(F.col("_b").cast("int"), F.lit(last)))
    # the largest id of each bucket: one row for each of the buckets reaches the driver
    firsts = {r["_b"]: r["k"] for r in ranked.groupBy("_b").agg(F.min("_k").alias("k")).collect()}
    filled = sorted(firsts)
    spark = docs.sparkSession
    before = spark.createDataFrame([(b, firsts[b], filled[i - 1]) for i, b in enumerate(filled)],
                                   "_b int, _first double, _before int")
    ranked = ranked.join(F.broadcast(before), "_b")
    is_first = F.col("_k").eqNullSafe(F.col("_first"))
    places = F.when(is_first, F.array(F.struct(F.col("_b").alias("at"), F.lit(0).alias("copy")),
                                      F.struct(F.col("_before").alias("at"), F.lit(1).alias("copy")))
                    ).otherwise(F.array(F.struct(F.col("_b").alias("at"), F.lit(0).alias("copy"))))
    dealt = ranked.withColumn("_place", F.explode(places)).select(
        *docs.columns, "_k", "_tie", F.col("_place.at").alias("_at"), F.col("_place.copy").alias("_copy"))
    order = Window.partitionBy("_at").orderBy("_copy", F.col(id_col).desc_nulls_last(), "_tie")
    out = dealt.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return out.where("_copy = 0").drop("_k", "_tie", "_at", "_copy")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      buckets: int | None = None) -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next and edited_sections (positions of the edited text's sections
    that differ). The edited text has the last third of the text replaced by the first
    as many characters of the next document."""
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = with_fingerprint(docs.select(id_col, text_of(text_col).alias("text")), "text", "fingerprint")
    near = with_next(texts, id_col, ["text", "fingerprint"], F.xxhash64("text"), buckets)
    edited = near.withColumn("n_chars", F.length("text").cast("bigint")).withColumn("edited", F.concat(
        F.expr("substring(text, 1, cast(n_chars - n_chars div 3 as int))"),
        F.expr("substring(next_text, 1, cast(n_chars div 3 as int))")))
    out = with_fingerprint(edited, "edited", "edited_fingerprint")
    return out.select(
        id_col, "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        F.array_join(changed_sections(F.col("fingerprint"), F.col("edited_fingerprint")).cast("array<string>"), ",")
        .alias("edited_sections"))
