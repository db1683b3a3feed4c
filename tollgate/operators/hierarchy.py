"""Base-impact hierarchy: root-to-node sort path and depth, a join per level."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions.labels import flag, sort_segment
from tollgate.functions.text import collated, distinct_rows
from tollgate.operators.joins import NAMED_ROW_BYTES, broadcast_if_bounded, key_bounds
from tollgate.plans.materialize import materialize
from tollgate.sources.tables import TEXT_KEYS


def tree_path(spark: SparkSession, base_impact: DataFrame, program_id: int | str) -> DataFrame:
    """(base_impact_id, parent_id, sort_path, depth) for every node under the program's roots.

    The sort path is '::NNN' per level, NNN the last three digits of the integer
    sort order, so text order is pre-order within a level's first 1000 siblings.

    The first level takes the program's roots; a further one the children of any program
    (a child is not re-filtered by program; the attribute list below is). Each level is
    one distributed join of the hierarchy with the level before, written once, so
    Spark's cap on the rows of a recursive query does not apply. A cycle is an error
    at the session's recursion level limit (100 by default).
    """
    bi = base_impact.select("base_impact_id", "parent_id", "program_id", sort_segment(F.col("sort_order")).alias("segment"))
    most = int(spark.conf.get("spark.sql.cteRecursionLevelLimit"))
    nodes = bi.select(F.col("base_impact_id").alias("_id"), F.col("parent_id").alias("_parent"), "segment")
    level = bi.where(F.col("parent_id").isNull() & (F.col("program_id") == program_id)).select(
        "base_impact_id", "parent_id", F.col("segment").alias("sort_path"), F.lit(1).alias("depth"))
    levels = []
    while True:
        level = materialize(level)
        bound = key_bounds(level, "base_impact_id", "sort_path")
        n = bound["base_impact_id"].rows
        if levels and not n:
            break
        levels.append(level)
        if 0 <= most < len(levels):
            raise ValueError(f"the base-impact hierarchy has more than {most} levels, or a cycle")
        width = NAMED_ROW_BYTES + sum(b.row_bytes for b in bound.values())
        parents = level.select("base_impact_id", "sort_path", "depth")
        level = nodes.join(broadcast_if_bounded(parents, n, width), F.col("_parent") == F.col("base_impact_id")).select(
            F.col("_id").alias("base_impact_id"), F.col("_parent").alias("parent_id"),
            F.concat("sort_path", "segment").alias("sort_path"), (F.col("depth") + 1).alias("depth"))
    return reduce(DataFrame.unionByName, levels)


def tree_attributes(spark: SparkSession, base_impact: DataFrame, program_id: int | str,
                    text_collation: str | None = None) -> DataFrame:
    """Distinct base impacts of the program with flags, level and sort path. With a collation,
    a parent's id matches its children's under it."""
    base_impact = collated(base_impact, TEXT_KEYS, text_collation)
    paths = tree_path(spark, base_impact, program_id)
    bi = base_impact.where(F.col("program_id") == program_id)
    attrs = (
        bi.join(paths.select("base_impact_id", "sort_path", "depth"), "base_impact_id")
        .select(
            F.col("base_impact_id").alias("BaseImpactID"),
            F.col("base_impact_name").alias("BaseImpactName"),
            flag(F.col("financial") == True).alias("IsFinancial"),  # noqa: E712
            flag(F.col("calculated") == True).alias("IsCalculated"),  # noqa: E712
            flag(F.col("timing") == 2).alias("IsRecurring"),
            F.col("unit").alias("Unit"),
            F.col("depth").alias("BaseImpactLevel"),
            F.col("sort_path").alias("BaseImpactPath"),
            F.col("parent_id").alias("BaseImpactParentBaseImpactID"),
        )
    )
    return distinct_rows(attrs, text_collation)
