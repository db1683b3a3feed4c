"""Pre-order and depth of a hierarchy in rounds that grow with the logarithm of its size, not with its depth.

The tree is walked on paper first (an Euler tour): every node has an arc that enters it and one that
leaves it, and every arc knows the next one, from joins of siblings and parents. The arcs form one
list from the first root to the last. List ranking by pointer doubling then lets every
arc add up what its reach covers and jump as far again: after k rounds it has seen 2^k arcs.
What an arc has counted to the end of the list gives its node's position and depth. A
chain of any depth takes as many rounds as a flat tree of its size, and no path text grows with the depth.

Arcs that never reach an end lie on or below a cycle, which is an error that names some of
those nodes. Nodes below a missing parent, or below roots of other programs, form lists of
their own and are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions.labels import sort_segment
from tollgate.operators.ordering import with_ordinal
from tollgate.plans.materialize import materialize

ROOT, OTHER_ROOT, CHILD = 0, 1, 2
SHOWN = 20  # nodes of a cycle that the error names


def _arcs(placed: DataFrame) -> DataFrame:
    """(arc, next, entered, level): arc 2k enters node k and 2k + 1 leaves it; `entered` and `level` are
    what the arc itself adds. No key is hot: siblings are neighbours in one order, and only
    the last of them looks its parent up."""
    follower = placed.select((F.col("ordinal") - 1).alias("ordinal"), F.col("kind").alias("f_kind"), F.col("parent_id").alias("f_parent"))
    alike = (F.col("kind") == F.col("f_kind")) & (F.col("kind") != OTHER_ROOT) & F.col("parent_id").eqNullSafe(F.col("f_parent"))
    linked = placed.join(follower, "ordinal", "left").withColumn("has_next", F.coalesce(alike, F.lit(False)))
    child = placed.where(F.col("kind") == CHILD).groupBy("parent_id").agg(F.min("ordinal").alias("child"))
    enter = placed.join(child.withColumnRenamed("parent_id", "base_impact_id"), "base_impact_id", "left").select(
        (2 * F.col("ordinal")).alias("arc"), F.coalesce(2 * F.col("child"), 2 * F.col("ordinal") + 1).alias("next"),
        F.lit(1).cast("bigint").alias("entered"), F.lit(1).cast("bigint").alias("level"))
    onward = linked.where("has_next").select((2 * F.col("ordinal") + 1).alias("arc"), (2 * F.col("ordinal") + 2).alias("next"))
    upward = linked.where("not has_next").select("ordinal", "parent_id").join(
        placed.select(F.col("base_impact_id").alias("parent_id"), F.col("ordinal").alias("up")), "parent_id", "left").select(
        (2 * F.col("ordinal") + 1).alias("arc"), (2 * F.col("up") + 1).alias("next"))
    leave = onward.union(upward).select("arc", "next", F.lit(0).cast("bigint").alias("entered"), F.lit(-1).cast("bigint").alias("level"))
    return enter.union(leave).withColumn("last", F.col("arc"))


def _ranked(arcs: DataFrame, n_nodes: int, placed: DataFrame) -> DataFrame:
    """The arcs with what lies from each to the end of its list, and the list's last arc."""
    arcs = materialize(arcs)
    for _ in range((2 * max(n_nodes, 1)).bit_length() + 1):
        # arcs that have reached their end stay out of the join (their null keys would meet in one task)
        ended, open_ = arcs.where("next is null"), arcs.where("next is not null")
        if open_.isEmpty():
            return arcs
        ahead = arcs.select(F.col("arc").alias("next"), F.col("next").alias("n_next"), F.col("entered").alias("n_entered"),
                            F.col("level").alias("n_level"), F.col("last").alias("n_last"))
        jumped = open_.join(ahead, "next").select(
            "arc", F.col("n_next").alias("next"), (F.col("entered") + F.col("n_entered")).alias("entered"),
            (F.col("level") + F.col("n_level")).alias("level"), F.col("n_last").alias("last"))
        arcs = materialize(ended.union(jumped))
    stuck = arcs.where("next is not null").select(F.floor(F.col("arc") / 2).cast("bigint").alias("ordinal")).distinct()
    if stuck.isEmpty():
        return arcs
    names = [str(r[0]) for r in placed.join(stuck, "ordinal").select("base_impact_id").limit(SHOWN).collect()]
    raise ValueError(f"the base-impact hierarchy has a cycle; on it or below it are {', '.join(sorted(names))}")


def tree_order(spark: SparkSession, base_impact: DataFrame, program_id: int | str) -> DataFrame:
    """(base_impact_id, parent_id, position, depth) of every node under the program's roots: position
    1, 2, ... in pre-order, siblings by sort segment and then id. As in `tree_path`, children
    of any program are followed. A repeated or null id is an error."""
    program = F.coalesce(F.col("program_id") == program_id, F.lit(False))
    kind = F.when(F.col("parent_id").isNotNull(), CHILD).when(program, ROOT).otherwise(OTHER_ROOT)
    nodes = materialize(base_impact.select("base_impact_id", "parent_id", kind.alias("kind"),
                                           sort_segment(F.col("sort_order")).alias("segment")))
    if not nodes.groupBy("base_impact_id").count().where("count > 1 or base_impact_id is null").isEmpty():
        raise ValueError("the base-impact hierarchy repeats an id, or has a null one")
    placed = materialize(with_ordinal(nodes, ["kind", "parent_id", "segment", "base_impact_id"]))
    facts = placed.agg(F.count("*").alias("n"), F.max(F.when(F.col("kind") == ROOT, F.col("ordinal"))).alias("root")).first()
    ranked = _ranked(_arcs(placed), facts["n"], placed)
    # the program's list ends where its last root is left
    end = -1 if facts["root"] is None else 2 * facts["root"] + 1
    inside = ranked.where((F.col("last") == end) & (F.col("arc") % 2 == 0))
    total = inside.agg(F.max("entered")).first()[0] or 0
    return placed.join(inside.select((F.col("arc") / 2).cast("bigint").alias("ordinal"), "entered", "level"), "ordinal").select(
        "base_impact_id", "parent_id", (F.lit(total) - F.col("entered") + 1).alias("position"),
        (1 - F.col("level")).cast("int").alias("depth"))
