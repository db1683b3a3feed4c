r"""Mixing sources to target weights by pivotal dependent rounding.

Each source gets a target number of words; a document of the source is wanted
target / source_size times, a whole number of copies plus a fraction. The fractions are
rounded in pairs: as many words' worth of probability as one of the two can take or
give moves between them, in a random direction chosen so that neither expectation
changes, until one is at 0 or 1; the other goes on to the next pair. The words taken
thereby stay at the target, but for the one document of a source that is left at the end.

A tree carries this out: the documents of a source are split by hash into groups of a
bounded size, each group leaves one document with a fraction, and the left ones of up to
`fan_in` groups meet on the next level until a source has one. So a source that holds a third
of all rows is no hot group, and nothing of it passes through the driver. Rows that share
source, id and text would share a group; many of them are dealt over the source's groups in turn.

Defined results: null texts have size 0 and take 0 words; sources are ordered by code
point with null last, a source of its own; a source of size 0 has target 0. Rows that share
id and text are interchangeable: as many of them are taken as drawn, whichever. The draws
depend on the ids and texts only, so reruns agree. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import text_of
from tollgate.operators.joins import broadcast_if_bounded, key_bounds
from tollgate.operators.ordering import with_ordinal
from tollgate.plans.materialize import materialize

# fixed values: the query's weights by source in turn, its total share and its limit
WEIGHTS = (3.0, 1.0, 2.0)
TOTAL_SHARE = 1.5
MAX_COPIES = 2.0
GROUP_ROWS = 1024
FAN_IN = 256


def n_words(text: Column) -> Column:
    """Number of runs of characters other than blank and the controls 9 to 13."""
    return F.when(F.length(text) > 0, F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))).otherwise(0).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, total_share: float = TOTAL_SHARE,
                   max_copies: float = MAX_COPIES) -> DataFrame:
    """`sizes` (source, source_size) plus target. The weights go round the sources in order; a
    target stops at max_copies times its source's size and the excess is shared by weight
    among the others until none is above. Only sums pass through the driver."""
    ordered = with_ordinal(sizes.withColumn("_none", F.col("source").isNull()), ["_none", "source"], "_at").drop("_none")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    left = materialize(ordered.withColumn("_weight", F.element_at(turn, ((F.col("_at") - 1) % len(weights) + 1).cast("int"))))
    limit = F.col("source_size") * max_copies
    total = total_share * (left.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        # those at their limit at this level keep it; the others share the rest by weight
        full = F.col("_weight") * level >= limit
        row = left.agg(F.sum(F.when(full, limit).otherwise(0.0)).alias("fixed"),
                       F.sum(F.when(full, 0.0).otherwise(F.col("_weight"))).alias("weight")).first()
        if not row["weight"]:
            break
        higher = (total - row["fixed"]) / row["weight"]
        if higher <= level * (1 + 1e-12):
            break
        level = higher
    return left.withColumn("target", F.least(limit, F.col("_weight") * level)).drop("_at", "_weight")


def pivot(size: np.ndarray, share: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, int]:
    """Rounds `share` (in 0 to 1) until at most one is between: the shares, and the place
    of the one between (-1 for none). The sum of size * share does not change. Large sizes
    go first, so that the one left is a small one where that can be."""
    x, open_at = share.copy(), -1
    draw = rng.random(len(x))
    for i in np.argsort(-size, kind="stable"):
        if not 0 < x[i] < 1:
            continue
        if open_at < 0:
            open_at = i
            continue
        j = open_at
        # words that can move from i to j, and from j to i
        to_j = min(x[i] * size[i], (1 - x[j]) * size[j])
        to_i = min(x[j] * size[j], (1 - x[i]) * size[i])
        moved = to_j if draw[i] * (to_i + to_j) < to_i else -to_i
        x[i] -= moved / size[i]
        x[j] += moved / size[j]
        for k in (i, j):
            if x[k] < 1e-9 or x[k] > 1 - 1e-9:
                x[k] = round(x[k])
        between = [k for k in (j, i) if 0 < x[k] < 1]
        open_at = between[0] if between else -1
    return x, int(open_at)


def _round_groups(frame: DataFrame, keys: list[str], seed: int, last: bool) -> DataFrame:
    """`frame` (source_key, group, key columns, size, share) with the shares of each group
    rounded by `pivot`; `last` also decides the one left. Groups are of bounded size."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values([*keys, "size"], kind="stable", ignore_index=True)
        first = group.iloc[0]
        rng = np.random.default_rng([seed, int(first["source_key"]) % (1 << 63), int(first["group"])])
        x, left = pivot(group["size"].to_numpy(dtype=np.float64), group["share"].to_numpy(dtype=np.float64), rng)
        if last and left >= 0:
            x[left] = float(rng.random() < x[left])
        return group.assign(share=x)

    return frame.groupBy("source_key", "group").applyInPandas(run, frame.schema)


def dealt(sized: DataFrame, alike: list[str], most: int) -> DataFrame:
    """`sized` (with a unique `row`) plus `turn`: 0 for rows that at most `most` rows share the
    `alike` columns with; consecutive numbers for the rows of larger sets. Rows of a set
    are interchangeable, so the numbers of a set depend on the `alike` columns only."""
    sets = materialize(sized.groupBy(*alike).count().where(F.col("count") > most).select(
        *[F.col(c).alias(f"_set{i}") for i, c in enumerate(alike)], F.lit(True).alias("_many")))
    bounds = key_bounds(sets, *[c for c in sets.columns if c != "_many"]).values()
    n_sets = max(b.rows for b in bounds)
    if not n_sets:
        return sized.withColumn("turn", F.lit(0).cast("bigint"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_set{i}")) for i, c in enumerate(alike)])
    marked = sized.join(broadcast_if_bounded(sets, n_sets, sum(b.row_bytes for b in bounds)), same, "left").select(*sized.columns, "_many")
    many = with_ordinal(marked.where("_many").drop("_many"), [*alike, "row"], "turn")
    few = marked.where("_many is null").drop("_many").withColumn("turn", F.lit(0).cast("bigint"))
    return few.unionByName(many)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 11,
        group_rows: int = GROUP_ROWS, fan_in: int = FAN_IN, **targets) -> DataFrame:
    """One row per document: id, text_key, size, source_size, target, copies and taken (copies
    * size). `targets` are options of source_targets."""
    sized = materialize(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col), F.col(source_col).alias("source"),
        F.xxhash64(text_of(text_col)).alias("text_key"), n_words(F.col(text_col)).alias("size")))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    aims = materialize(source_targets(sizes, **targets)).withColumnRenamed("source", "_source")
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # the tree's leaves: as many groups as the source's rows need; a document's group
    # depends on its id and text, and on its turn where many rows share these
    key = F.xxhash64(F.lit(seed), id_col, "text_key")
    groups = F.ceil(F.col("_rows") / group_rows)
    rows = materialize(dealt(sized, ["source", id_col, "text_key"], max(1, group_rows // 4)).join(aims, F.col("source").eqNullSafe(F.col("_source"))).select(
        "row", id_col, "text_key", "size", "source_size", "target", F.floor(wanted).alias("whole"),
        (wanted - F.floor(wanted)).alias("share"), F.xxhash64("source", F.col("source").isNull()).alias("source_key"),
        key.alias("key"), F.pmod(F.pmod(key, groups) + F.col("turn"), groups).alias("group"), groups.alias("groups")))
    most = rows.agg(F.max("groups")).first()[0] or 1
    tree = rows.where("share > 0 and size > 0").select("source_key", "group", "key", "row", "size", "share")
    up = []
    while True:
        level = materialize(_round_groups(tree, ["key"], seed, most == 1))
        up.append(level.where("share = 1").select("row", F.lit(1).alias("up")))
        if most == 1:
            break
        most = -(-most // fan_in)
        tree = level.where("share > 0 and share < 1").withColumn("group", F.floor(F.col("group") / fan_in))
    rounded = up[0]
    for more in up[1:]:
        rounded = rounded.unionByName(more)
    copies = F.col("whole") + F.coalesce("up", F.lit(0))
    return rows.join(rounded, "row", "left").select(
        id_col, "text_key", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"))
