"""URL filter: hand-kept host/path rules, then association rules mined from labelled URLs.

Hand-kept rules decide first; the longest that fits wins. The other URLs are judged by
rules that FP-growth mines: each labelled URL is a transaction of its tokens and its
class (block or allow), and a token combination whose support, confidence for a class and lift
over the class's share reach the thresholds is a rule for that class. Rules are looked up through an
inverted index that posts each rule under its rarest token; a URL meets only the rules posted
under its own tokens, and the most confident one that fits decides.

Defined results: a null URL, or one without `://`, has empty host and path, no tokens and
no rule, so it is allowed. Repeated rows and repeated page ids each keep their own row.
No labelled URL, or no rule that passes, leaves the hand-kept rules alone. Tokens that all
labelled URLs have tell nothing and are in no rule; of tokens that occur in the same labelled URLs
the first by text stands for all, so tokens that always go together add no combinations.
Columns of the input other than the id and the URL are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import lower_ascii
from tollgate.operators.joins import fits_broadcast
from tollgate.plans.materialize import materialize

BLOCK, ALLOW = "block", "allow"
CLASS_ITEM = "class:"
RULE_BYTES = 128  # of an index row beside its texts

# fixed values: the rules the query is asked to start from
BASE_RULES = (("net/", BLOCK), ("example.net/en/", ALLOW), ("example.com/de/", BLOCK), ("org/fr/", ALLOW))


def url_host(url: Column) -> Column:
    """Between the first `://` and the next `/`, `?` or `#`, A-Z lower-cased; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """From the end of the host to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Sorted distinct items of a URL: scheme, host labels, path parts with numbers
    masked, query keys, and a mark for a fragment. Empty without `://`."""
    full = F.coalesce(url, F.lit(""))
    scheme = lower_ascii(F.regexp_extract(full, r"(?s)^(.*?)://", 1))
    query = F.regexp_extract(full, r"(?s)^[^?#]*\?([^#]*)", 1)

    def items(prefix: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(prefix), x))

    tokens = F.concat(
        items("s:", F.array(scheme)),
        items("h:", F.split(host, r"\.")),
        items("p:", F.split(F.regexp_replace(path, "[0-9]+", "#"), r"[/.]")),
        items("q:", F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))),
        items("f:", F.array(F.when(full.contains("#"), F.lit("yes")).otherwise(F.lit("")))),
    )
    return F.when(full.contains("://"), F.array_sort(F.array_distinct(tokens))).otherwise(
        F.array().cast("array<string>"))


def longest_rule(host: Column, path: Column, rules) -> Column:
    """The longest of the (rule, verdict) pairs that fits, as a struct, or null. Rules
    are a short hand-kept list, so they are part of the expression."""
    def fits(rule: str) -> Column:
        rule_host, _, rest = rule.partition("/")
        return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rest)

    ordered = sorted(rules, key=lambda r: (-len(r[0]), r[0]))
    hits = [F.when(fits(rule), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")))
            for rule, verdict in ordered]
    return F.coalesce(*hits) if hits else F.lit(None).cast("struct<rule:string,verdict:string>")


def telling_tokens(labelled: DataFrame, n: int) -> DataFrame:
    """(row, tokens) of `labelled` (row, tokens) without tokens that all `n` rows have, and with one
    token, the first by text, of those that occur in the same rows. Sets of rows are told apart by their
    size and the sums of two hashes of their rows, so no list of rows is gathered."""
    each = labelled.select("row", F.explode("tokens").alias("token"))
    hashes = [F.sum(F.xxhash64(F.lit(seed), "row").cast("decimal(20,0)")).alias(f"h{seed}") for seed in (0, 1)]
    rows_of = each.groupBy("token").agg(F.count("*").alias("n"), *hashes).where(F.col("n") < n)
    first = materialize(rows_of.groupBy("n", "h0", "h1").agg(F.min("token").alias("token")).select("token"))
    return each.join(first, "token").groupBy("row").agg(F.array_sort(F.collect_list("token")).alias("tokens"))


def mine_rules(labelled: DataFrame, min_support: float, min_confidence: float, min_count: int,
               min_lift: float) -> DataFrame:
    """Rules from `labelled` (row, tokens array<string>, blocked boolean): antecedent
    array<string> (sorted), verdict, support_count, confidence. A rule needs `min_support` of
    the labelled URLs and at least `min_count` of them, and a confidence of `min_confidence` and of
    `min_lift` times its class's share of them. FP-growth runs on Spark; only
    its table of single frequent items (at most tokens of a URL / min_support) passes
    through the driver."""
    total = labelled.agg(F.count("*").alias("n"), F.count(F.when(F.col("blocked"), 1)).alias("blocked")).first()
    n = total["n"]
    if n < min_count:  # fewer labelled URLs than a rule needs
        return labelled.sparkSession.createDataFrame(
            [], "antecedent array<string>, verdict string, support_count bigint, confidence double")
    of_class = F.concat(F.lit(CLASS_ITEM), F.when(F.col("blocked"), BLOCK).otherwise(ALLOW))
    telling = labelled.select("row", "blocked").join(telling_tokens(labelled, n), "row", "left")
    items = materialize(telling.select(
        F.concat(F.coalesce("tokens", F.array().cast("array<string>")), F.array(of_class)).alias("items")))
    support = max(min_support, (min_count - 0.5) / n)
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(items)
    share = F.when(F.col("verdict") == BLOCK, F.lit(total["blocked"] / n)).otherwise(F.lit((n - total["blocked"]) / n))
    mined = model.associationRules.where(F.col("consequent")[0].startswith(CLASS_ITEM)).withColumn(
        "verdict", F.substring(F.col("consequent")[0], len(CLASS_ITEM) + 1, 1 << 20))
    return mined.where(F.col("confidence") >= F.lit(float(min_lift)) * share).select(
        F.array_sort("antecedent").alias("antecedent"), "verdict",
        F.round(F.col("support") * n).cast("bigint").alias("support_count"), "confidence")


def match_rules(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """For each row of `token_sets` (distinct `tokens` arrays) that some rule fits: the
    most confident such rule (then most support, then by text) as mined_rule,
    mined_verdict and mined_confidence."""
    rules = materialize(rules.withColumn("rule_text", F.array_join("antecedent", " & ")))
    size = rules.agg(F.count("*").alias("n"), F.max(F.octet_length("rule_text")).alias("longest")).first()
    postings = rules.select("rule_text", F.explode("antecedent").alias("token")).distinct()
    # a token in many rules is a frequent token: the fewer rules it is in, the rarer
    weight = postings.groupBy("token").agg(F.count("*").alias("n"))
    pivot = (postings.join(weight, "token").groupBy("rule_text")
             .agg(F.min(F.struct("n", "token")).alias("rarest"))
             .select("rule_text", F.col("rarest.token").alias("token")))
    index = rules.join(pivot, "rule_text").select(
        "token", "antecedent", "rule_text", "verdict", "support_count", "confidence")
    # the rule's tokens stand in a row as text, as a list (16 bytes a token more) and once more as the key
    if fits_broadcast(size["n"], RULE_BYTES + 20 * (size["longest"] or 0)):
        index = F.broadcast(index)
    met = token_sets.select("tokens", F.explode("tokens").alias("token")).join(index, "token")
    fit = met.where(F.size(F.array_except("antecedent", "tokens")) == 0)
    best = fit.groupBy("tokens").agg(F.min(F.struct(
        (-F.col("confidence")).alias("c"), (-F.col("support_count")).alias("s"), "rule_text", "verdict")).alias("b"))
    return best.select("tokens", F.col("b.rule_text").alias("mined_rule"), F.col("b.verdict").alias("mined_verdict"),
                       (-F.col("b.c")).alias("mined_confidence"))


def judge_urls(pages: DataFrame, labelled_urls: DataFrame, rules=BASE_RULES, min_support: float = 0.002,
               min_confidence: float = 0.6, min_count: int = 10, min_lift: float = 1.1, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, mined_rule, mined_confidence.

    `labelled_urls` has the URLs to learn from (`url_col`, `blocked` boolean, null counts
    as not blocked); all of them are mined. Token sets repeat far more often than URLs
    (numbers are masked), so each distinct set is judged once, and a hot host or URL is
    merged before the shuffle.
    """
    url = F.col(url_col)
    host, path = url_host(url), url_path(url)
    parsed = pages.select(id_col, host.alias("host"), path.alias("path"), url_tokens(url, host, path).alias("tokens"))
    labelled = labelled_urls.select(F.monotonically_increasing_id().alias("row"), url_tokens(url, host, path).alias("tokens"),
                                    F.coalesce("blocked", F.lit(False)).alias("blocked"))
    mined = mine_rules(materialize(labelled), min_support, min_confidence, min_count, min_lift)
    # on its own, so that the join can split a token set that very many URLs have
    hits = materialize(match_rules(parsed.select("tokens").distinct(), mined))
    hand = longest_rule(F.col("host"), F.col("path"), rules)
    judged = parsed.join(hits, "tokens", "left").withColumn("hand", hand)
    method = F.coalesce("mined_verdict", F.lit(ALLOW))
    return judged.select(id_col, "host", "path", F.col("hand.rule").alias("rule"),
                         F.coalesce("hand.verdict", method).alias("verdict"), "mined_rule", "mined_confidence")
