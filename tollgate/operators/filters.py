"""Milestone due window and the three impact modes (the filtered milestone set)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.params import ImpactMode, ReportParams


def due_window(milestone: DataFrame, p: ReportParams) -> DataFrame:
    """Milestones with a plan date in the filter window, a forecast no later than
    today + N days (overdue ones included, NULL forecast excluded) and a status
    other than 1 (NULL status excluded).

    Every predicate compares a column with a constant, so all of them reach the
    parquet scan as pushed filters.
    """
    horizon = F.date_add(F.lit(p.today), p.due_in_next_n_days)
    return milestone.where(
        F.col("plan_date").isNotNull()
        & (F.col("plan_date") >= F.lit(p.filter_date_start))
        & (F.col("plan_date") <= F.lit(p.filter_date_end))
        & (F.col("forecast_date") <= horizon)
        & (F.col("tl_overall") != 1)
    )


def roadmaps_with_impact(impact: DataFrame, base_impact_id: str | None) -> DataFrame:
    """Distinct roadmap ids that have an impact (of the given base impact, if any).

    The distinct is aggregated map-side first, so the shuffle carries one row per
    roadmap and task rather than one per impact row.
    """
    imp = impact if base_impact_id is None else impact.where(F.col("base_impact_id") == base_impact_id)
    return imp.select("roadmap_id").distinct()


def apply_impact_mode(rows: DataFrame, impact: DataFrame, p: ReportParams) -> DataFrame:
    """Restrict milestone rows by the picked base impact and add `base_impact_id`.

    SELECTED keeps rows whose roadmap has an impact of the picked base impact (a
    semi join: the impact rows never multiply the milestones); UNSET keeps every
    row; NONE keeps rows whose roadmap has no impact at all (an anti join).
    """
    if p.impact_mode is ImpactMode.SELECTED:
        kept = rows.join(roadmaps_with_impact(impact, p.base_impact_id), "roadmap_id", "left_semi")
        return kept.withColumn("base_impact_id", F.lit(p.base_impact_id))
    if p.impact_mode is ImpactMode.NONE:
        kept = rows.join(roadmaps_with_impact(impact, None), "roadmap_id", "left_anti")
        return kept.withColumn("base_impact_id", F.lit(None).cast("string"))
    return rows.withColumn("base_impact_id", F.lit(None).cast("string"))
