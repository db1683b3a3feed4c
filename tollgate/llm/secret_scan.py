r"""Secret scan with corpus-wide ownership frequency.

Every text is searched for candidate values of four kinds: assignments, access ids and
hex keys (always reported) and opaque tokens (long varied runs with digits and capital
letters). Each distinct value is counted over the corpus: in how many repositories and
under how many owners it occurs. A value under many owners, or in many repositories of few
owners, is a widely copied example; one that a single owner has in few repositories, and
that looks random, is live-looking. Opaque tokens are
reported only where they are live-looking and no other span overlaps them.

Spans are code point offsets, end exclusive, of the whole match. Spark has no function
for match offsets, so they come from the lengths of the pieces between the matches
(`split`) and of the matches themselves; both see the same leftmost non-overlapping matches.

Defined results: a null or empty text has no spans. Rows are told apart by a row number
fixed in a checkpoint, so repeated rows and repeated or null ids each keep their own row.
A null owner counts as one owner of its own, a null repository as one repository. Only
the id, text and owner columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import text_of
from tollgate.plans.materialize import materialize

# fixed values: the patterns the query is asked to search
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
          r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_MIN = 6
# a run shorter than the least length holds no later start that is long enough, so
# the length can be part of these two patterns
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
OPAQUE = r"[A-Za-z0-9_-]{20,}"

KINDS = ("assign", "access", "hex", "opaque")
HIT = "array<struct<start:bigint,kind:int,end:bigint,value:string>>"


def matches(text: Column, pattern: str, kind: int, group: int = 0, min_value: int = 0) -> Column:
    """Array of (start, kind, end, value): the pattern's matches with their offsets.
    `value` is the given group; matches whose value is shorter than `min_value` go."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.split(text, pattern, -1)
    steps = F.arrays_zip(F.transform(between, F.length).alias("gap"), whole.alias("whole"), values.alias("value"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["whole"])
        hit = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["value"].alias("value"))
        keep = F.length(x["value"]) >= min_value
        return F.struct(end.alias("at"), F.when(keep, F.concat(acc["hits"], F.array(hit))).otherwise(acc["hits"]).alias("hits"))

    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(HIT).alias("hits"))
    # the piece after the last match has no match of its own
    return F.when(F.size(whole) > 0, F.aggregate(
        F.filter(steps, lambda x: x["whole"].isNotNull()), zero, add, lambda acc: acc["hits"])
    ).otherwise(F.array().cast(HIT))


def looks_random(value: Column, min_length: int = 16, min_distinct: int = 8) -> Column:
    """Long, varied, and with digits and letters both."""
    return ((F.length(value) >= min_length) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
            & (F.size(F.array_distinct(F.split(value, ""))) >= min_distinct))


def ownership(candidates: DataFrame) -> DataFrame:
    """(value_hash, owner, repo) occurrences to value_hash, n_repos, n_owners. Distinct
    (value, owner, repo) first, then per owner, then per value: each step merges on the
    map side, so a value that a third of the corpus copies is no hot key."""
    per_repo = candidates.groupBy("value_hash", "owner", "repo").agg(F.lit(1).alias("one"))
    per_owner = per_repo.groupBy("value_hash", "owner").agg(F.sum("one").alias("repos"))
    return per_owner.groupBy("value_hash").agg(F.sum("repos").alias("n_repos"), F.count("*").alias("n_owners"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 example_owners: int = 3, example_repos: int = 20) -> DataFrame:
    """One row per document: id and `hits`, the array of (start, kind, end, value_hash,
    class, n_repos, n_owners) in order of start and kind. `class` is example (at least `example_owners`
    owners or `example_repos` repositories), else live (one owner, random-looking), else unclear. A document
    is its own repository; `owner_col` names its owner."""
    text = text_of(text_col)
    opaque = F.filter(matches(text, OPAQUE, 3), lambda h: looks_random(h["value"], 20, 10)
                      & h["value"].rlike("[A-Z]"))
    found = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col), F.col(owner_col).alias("owner"),
        matches(text, ASSIGN, 0, 2, ASSIGN_MIN).alias("a"), matches(text, ACCESS, 1).alias("b"),
        matches(text, HEX, 2).alias("c"), opaque.alias("d"))
    base = F.concat("a", "b", "c")
    extra = F.filter("d", lambda x: ~F.exists(base, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])))
    hashed = F.transform(F.concat(base, extra), lambda h: F.struct(
        h["start"].alias("start"), h["kind"].alias("kind"), h["end"].alias("end"),
        F.sha2(h["value"], 256).alias("value_hash"), looks_random(h["value"]).alias("random")))
    rows = materialize(found.select("row", id_col, "owner", hashed.alias("hits")))
    seen = rows.select("row", F.col(id_col).alias("repo"), "owner", F.explode("hits").alias("hit"))
    # on its own, so that the join can split a value that very many documents have
    counts = materialize(ownership(seen.select(F.col("hit.value_hash").alias("value_hash"), "owner", "repo")))
    judged = seen.withColumn("value_hash", F.col("hit.value_hash")).join(counts, "value_hash")
    copied = (F.col("n_owners") >= example_owners) | (F.col("n_repos") >= example_repos)
    verdict = (F.when(copied, "example")
               .when((F.col("n_owners") == 1) & F.col("hit.random"), "live").otherwise("unclear"))
    hit = F.struct("hit.start", "hit.kind", "hit.end", "value_hash", verdict.alias("class"), "n_repos", "n_owners")
    # a document's hits are one cell of its own row, not a group over documents
    per_row = judged.groupBy("row").agg(F.array_sort(F.collect_list(hit)).alias("judged"))
    kept = F.filter(F.coalesce("judged", F.array()), lambda h: (h["kind"] < 3) | (h["class"] == "live"))
    return rows.select("row", id_col).join(per_row, "row", "left").select(id_col, kept.alias("hits"))


def span_list(hits: Column) -> Column:
    """`kind:start:end` of each hit, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(hits, lambda h: F.concat_ws(
        ":", name[h["kind"]], h["start"].cast("string"), h["end"].cast("string"))), ",")
