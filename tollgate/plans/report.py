"""The due / overdue / upcoming milestone report, wired from the operators.

Jobs of one report:
  1. driving set   roadmaps in the impact mode x due milestones, distinct, checkpointed
                   and counted; the request's one-row lookups run at the same time
  2. headers       per roadmap: valuation totals, roadmap, view, gate, owners,
                   statuses, stage; per project: name, number, workstream owner.
                   Built from the driving set's ids, large inputs pruned to those ids
                   by semi joins, distinct, both checkpointed concurrently
  3. report        milestone rows (with their narrative attributes) x roadmap
                   header x project header, one join each, both sides read from a
                   shuffle (AQE can split a hot roadmap or project); distinct parts
                   make distinct rows
Single-row dimensions (program, picked base impact, currency code) are constants.
The cache stage (operators/cache.py) stores report rows per project snapshot and
reads them back in tree order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.functions.html import strip_html
from tollgate.functions.labels import (
    TRAFFIC_LIGHT_DEFAULT,
    day_diff,
    project_url,
    roadmap_url,
    sentinel_datetime,
    traffic_light,
)
from tollgate.functions.text import distinct_rows
from tollgate.operators.asof import status_label, two_statuses
from tollgate.operators.attributes import NARRATIVE_COLUMNS, attribute_pivot
from tollgate.operators.enrich import (
    ROLE_ROADMAP_APPROVER,
    ROLE_ROADMAP_OWNER,
    ROLE_WORKSTREAM_OWNER,
    named_roles,
    owner_or_blank,
    role_holders,
    stage_gate,
)
from tollgate.operators.filters import apply_impact_mode, due_window
from tollgate.operators.joins import (
    NAMED_ROW_BYTES,
    KeyBound,
    broadcast_if_bounded,
    key_bounds,
    semi_join_keys,
)
from tollgate.operators.valuation import METRICS, value_keys
from tollgate.params import ImpactMode, ReportParams
from tollgate.plans.constants import resolve_constants, run_concurrently
from tollgate.plans.materialize import materialize
from tollgate.sources.tables import Tables, collate_keys

KEY_COLUMNS = ["program_id", "project_id", "roadmap_id", "milestone_id", "base_impact_id"]

# The report's columns, in report order.
REPORT_COLUMNS = [
    "PROJ_PARENT", "P_ID", "WS_OWNER", "PJ_Num", "RM_ID", "RM_TL_DICE", "RM_TL_MS", "RM_TL_IM",
    "RM_TL_OVERALL", "RM_NUMBER", "RM_OWNER", "RM_APPROVER", "MEMBER_NAME", "ROADMAP_DESCRIPTION",
    "Status_2Weeks_ago", "Status_1Weeks_ago", "A_Milestone", "Milestone_Sort_order", "A_Plan",
    "A_Forecast", "DELAY_OVERDUE", "MilestoneDueInNextNDays", "BI_NAME", "BI_UNIT", "CURRENCY_CODE",
    "RM_STAGE", "G4_DueDate", "PG_START_YEAR", "PG_END_YEAR", "Plan", "Update", "Actual",
    "Plan_To_Date", "Actual_To_Date", "Update_To_Date", "A_FK_Milestone", "A_FK_Project",
    "A_FK_BASE_IMPACT", "A_DICE_ENABLED", *NARRATIVE_COLUMNS, "ProjectURL", "RoadmapURL",
]


def milestone_base(t: Tables, p: ReportParams, projects: DataFrame | None = None) -> DataFrame:
    """Roadmaps of the program x due milestones, restricted by the impact mode; distinct rows.

    Columns: KEY_COLUMNS plus milestone_name, forecast_date, plan_date, update_date,
    milestone_sort_order. `projects` (frame with project_id) restricts the set to
    those projects before any join.

    The mode is applied to the roadmaps (one row each) and the result is written, so the join
    with the milestones, where a hot roadmap lives, shuffles both of its sides: AQE splits
    a skewed join only then.
    """
    fr = t.filtered_roadmap.where(F.col("program_id") == p.program_id).select(
        "roadmap_id", "program_id", "project_id"
    )
    if projects is not None:
        fr = semi_join_keys(fr, projects, "project_id", key_bounds(projects, "project_id")["project_id"])
    roadmaps = materialize(apply_impact_mode(fr, t.impact, p).distinct())
    ms = due_window(t.milestone, p).select(
        "roadmap_id", "milestone_id", "milestone_name", "forecast_date", "plan_date", "update_date",
        F.col("sort_order").alias("milestone_sort_order"),
    )
    rows = roadmaps.join(ms, "roadmap_id").select(
        *KEY_COLUMNS, "milestone_name", "forecast_date", "plan_date", "update_date", "milestone_sort_order")
    return distinct_rows(rows, p.text_collation)


def driving_set(t: Tables, p: ReportParams, projects: DataFrame | None = None) -> tuple[DataFrame, dict[str, KeyBound]]:
    """The milestone base, checkpointed, and the checked size of its id columns (one pass
    over the checkpoint). A milestone that occurs twice in a roadmap would make the
    source's re-joins ambiguous, so it is an error."""
    base = materialize(milestone_base(t, p, projects))
    twice = base.groupBy("program_id", "project_id", "roadmap_id", "milestone_id").count().where("count > 1")
    if not twice.isEmpty():
        raise ValueError("milestone repeats a (roadmap, milestone) key")
    return base, key_bounds(base, "roadmap_id", "milestone_id", "project_id")


def filtered_milestones(t: Tables, p: ReportParams, projects: DataFrame | None = None,
                        base: DataFrame | None = None, bounds: dict[str, KeyBound] | None = None) -> DataFrame:
    """The report's roadmap x milestone set with its narrative attributes (distinct rows).

    Columns: KEY_COLUMNS, milestone_name, datedif, the narrative attributes, and the
    milestone fields the report shows (sort order, plan and update dates). The base is
    distinct and has one row of attributes per milestone, so no wide row is compared.
    """
    if base is None:
        base, bounds = driving_set(t, p, projects)
    attrs = attribute_pivot(t.milestone_attribute, base, bounds["milestone_id"], p.attribute_ids,
                            p.text_collation)
    return base.join(attrs, "milestone_id", "left").select(
        *KEY_COLUMNS,
        "milestone_name",
        day_diff(F.col("forecast_date"), F.lit(p.today)).alias("datedif"),
        *NARRATIVE_COLUMNS,
        "milestone_sort_order", "plan_date", "update_date",
    )


def valued_milestones(t: Tables, p: ReportParams, projects: DataFrame | None = None) -> DataFrame:
    """Distinct milestone keys with their factor and six metrics (the valuation
    alone), planned like the report: constants and driving set resolved
    concurrently, impact rows pruned to the keys' roadmaps."""
    t = collate_keys(t, p.text_collation)
    consts, extra = resolve_constants(t, p, {"base": lambda: driving_set(t, p, projects)})
    base, bounds = extra["base"]
    # roadmap-level metrics first (one row per roadmap and factor), checkpointed so
    # the join with the milestone keys reads both sides from a shuffle (splittable
    # by AQE for a roadmap with very many milestones)
    per_roadmap = materialize(value_keys(base.select("roadmap_id").distinct(), t, p, consts, bounds["roadmap_id"]))
    return base.select(*KEY_COLUMNS).join(per_roadmap, "roadmap_id", "left").select(*KEY_COLUMNS, *per_roadmap.columns[1:])


def status_frames(t: Tables, p: ReportParams, rows: DataFrame,
                  n_roadmaps: KeyBound | None = None) -> tuple[DataFrame, DataFrame]:
    """Status 14 days (2 weeks) and 7 days (1 week) before the as-of date, for the
    roadmaps in `rows`, from one scan of the history."""
    roadmaps = rows.select("roadmap_id")  # broadcast as is, or made distinct by the shuffled semi join
    return two_statuses(t.roadmap_audit, roadmaps, p.status_as_of, 14, 7,
                        n_roadmaps or key_bounds(roadmaps, "roadmap_id")["roadmap_id"])


def report_rows(t: Tables, p: ReportParams, projects: DataFrame | None = None) -> DataFrame:
    """The 48-column report (distinct rows) for the program, optionally restricted
    to `projects` before any work is done."""
    t = collate_keys(t, p.text_collation)
    # The driving set is read by the attributes, the statuses, the valuation and the
    # headers: it is computed once and its lineage cut. That job and the small lookups
    # of the request's constants run concurrently. Its ids are counted once from the
    # checkpoint: every large dimension is cut to them before it is shuffled for its join.
    consts, extra = resolve_constants(t, p, {"base": lambda: driving_set(t, p, projects)})
    base, bounds = extra["base"]

    def prune(df: DataFrame, key: str) -> DataFrame:
        return semi_join_keys(df, base, key, bounds[key])

    rows = filtered_milestones(t, p, base=base, bounds=bounds)
    # narratives join on (roadmap, milestone, base impact) with plain equality:
    # a NULL base impact (UNSET / NONE) matches nothing, so they are NULL then
    if p.impact_mode is not ImpactMode.SELECTED:
        rows = rows.select(
            *[F.lit(None).cast("string").alias(c) if c in NARRATIVE_COLUMNS else F.col(c)
              for c in rows.columns]
        )

    rm = prune(t.roadmap, "roadmap_id").select(
        "roadmap_id", F.col("roadmap_id").alias("rm_id"), "roadmap_name",
        strip_html(F.col("description")).alias("description"), F.col("stage_id").alias("rm_stage_id"))
    rmv = prune(t.roadmap_view, "roadmap_id").select(
        "roadmap_id", "roadmap_number", "tl_dice", "tl_milestone", "tl_impact",
        F.col("tl_overall").alias("rm_tl_overall"))
    gate = stage_gate(prune(t.roadmap_view, "roadmap_id"), prune(t.roadmap_stage, "roadmap_id"), p.gate_stage_id)
    pj = prune(t.project, "project_id").select(
        "project_id", "project_name", "project_number", "parent_project_id", F.col("project_id").alias("pj_id"))
    stage = broadcast_if_bounded(t.stage.select(F.col("stage_id").alias("rm_stage_id"), "stage_name"),
                                 consts.n_stages, NAMED_ROW_BYTES)
    # the roles of the driving set's roadmaps and projects: cut inside the scans, before
    # the names are joined, made distinct and written
    roles = prune(t.user_role.where(F.col("role").isin(ROLE_ROADMAP_OWNER, ROLE_ROADMAP_APPROVER)), "roadmap_id").unionByName(
        prune(t.user_role.where(F.col("role") == ROLE_WORKSTREAM_OWNER), "project_id"))
    # the two inputs that feed several header columns
    parts = run_concurrently({
        "status": lambda: status_frames(t, p, base, bounds["roadmap_id"]),
        "roles": lambda: materialize(named_roles(roles, t.users, {
            ROLE_WORKSTREAM_OWNER: "project_id", ROLE_ROADMAP_OWNER: "roadmap_id", ROLE_ROADMAP_APPROVER: "roadmap_id"},
            p.text_collation)),
    })
    s14, s7 = parts["status"]

    def holders(role: int, key: str, name: str) -> DataFrame:
        return role_holders(parts["roles"], role, key, p.fold_multi_valued).withColumnRenamed("holder", name)

    def label(status: DataFrame, name: str) -> DataFrame:
        return status_label(status, p.fold_multi_valued).withColumnRenamed("label", name)

    # one-row dimensions of the report request, resolved above, used as constants
    pg_start, pg_end, pg_dice = (consts.program[k] for k in ("start_date", "end_date", "dice_enabled"))
    currency_code = consts.currency_code
    bi_name, bi_unit, bi_fin = (consts.base_impact[k] for k in ("base_impact_name", "unit", "financial"))

    # Headers: everything the report shows per roadmap (valuation included) and per
    # project, each built from the driving set's distinct ids. A side of those joins has
    # one row per id, or one per holder of a role or tied status of that id. The milestone
    # rows, where a hot roadmap or project lives, then meet each header in exactly one
    # join that reads straight from a shuffle, which is what AQE needs to split a skewed
    # partition.
    roadmap_ids = base.select("roadmap_id").distinct()
    roadmap_header = (
        value_keys(roadmap_ids, t, p, consts, bounds["roadmap_id"])
        .join(rm, "roadmap_id", "left")
        .join(rmv, "roadmap_id", "left")
        .join(gate, "roadmap_id", "left")
        .join(holders(ROLE_ROADMAP_OWNER, "roadmap_id", "rm_owner"), "roadmap_id", "left")
        .join(holders(ROLE_ROADMAP_APPROVER, "roadmap_id", "rm_approver"), "roadmap_id", "left")
        .join(label(s14, "status_14"), "roadmap_id", "left")
        .join(label(s7, "status_7"), "roadmap_id", "left")
        .join(stage, "rm_stage_id", "left")
        .select("roadmap_id", "rm_id", "roadmap_name", "description", "roadmap_number",
                *[traffic_light(F.col(c)).alias(c) for c in ("tl_dice", "tl_milestone", "tl_impact", "rm_tl_overall")],
                *[owner_or_blank(c).alias(c) for c in ("rm_owner", "rm_approver")],
                *[F.coalesce(F.col(c), F.lit(TRAFFIC_LIGHT_DEFAULT)).alias(c) for c in ("status_14", "status_7")],
                sentinel_datetime(F.col("gate_plan_date")).alias("gate_plan_date"), "stage_name", *METRICS)
    )
    project_header = (
        base.select("project_id").distinct()
        .join(pj, "project_id", "left")
        .join(holders(ROLE_WORKSTREAM_OWNER, "project_id", "ws_owner"), "project_id", "left")
        # the workstream owner is found through the project row: none without it
        .withColumn("ws_owner", F.when(F.col("pj_id").isNull(), F.lit("")).otherwise(owner_or_blank("ws_owner")))
    )
    # The report's DISTINCT is taken part by part. A report row is a milestone row, a
    # roadmap header and a project header side by side, each column from one of them and
    # the ids of all three among them, so distinct parts make distinct rows; the
    # wide rows with their texts are never compared or shuffled as a whole.
    roadmap_header = distinct_rows(roadmap_header, p.text_collation)
    project_header = distinct_rows(project_header, p.text_collation)
    # AQE splits a skewed sort-merge join only when both sides are read from a
    # shuffle; a header built by joins on the same key arrives without one. The
    # headers (id-level, far smaller than the milestone rows) are checkpointed,
    # concurrently, so the final joins shuffle both sides and stay splittable.
    headers = run_concurrently({"roadmap": lambda: materialize(roadmap_header),
                                "project": lambda: materialize(project_header)})
    roadmap_header, project_header = headers["roadmap"], headers["project"]
    j = rows.join(roadmap_header, "roadmap_id", "left").join(project_header, "project_id", "left")
    lit = F.lit
    # financial base impact -> the report currency's code, otherwise (or no base impact) ''
    currency_label = lit(currency_code if bi_fin is True else "").cast("string")
    out = j.select(
        F.col("project_name").alias("PROJ_PARENT"),
        F.col("pj_id").alias("P_ID"),
        F.col("ws_owner").alias("WS_OWNER"),
        F.col("project_number").alias("PJ_Num"),
        F.col("rm_id").alias("RM_ID"),
        F.col("tl_dice").alias("RM_TL_DICE"),
        F.col("tl_milestone").alias("RM_TL_MS"),
        F.col("tl_impact").alias("RM_TL_IM"),
        F.col("rm_tl_overall").alias("RM_TL_OVERALL"),
        F.col("roadmap_number").alias("RM_NUMBER"),
        F.col("rm_owner").alias("RM_OWNER"),
        F.col("rm_approver").alias("RM_APPROVER"),
        F.col("roadmap_name").alias("MEMBER_NAME"),
        F.col("description").alias("ROADMAP_DESCRIPTION"),
        F.col("status_14").alias("Status_2Weeks_ago"),
        F.col("status_7").alias("Status_1Weeks_ago"),
        F.col("milestone_name").alias("A_Milestone"),
        F.col("milestone_sort_order").alias("Milestone_Sort_order"),
        sentinel_datetime(F.col("plan_date")).alias("A_Plan"),
        sentinel_datetime(F.col("update_date")).alias("A_Forecast"),
        day_diff(F.col("plan_date"), lit(p.today)).alias("DELAY_OVERDUE"),
        lit(p.due_in_next_n_days).alias("MilestoneDueInNextNDays"),
        lit(bi_name).cast("string").alias("BI_NAME"),
        lit(bi_unit).cast("string").alias("BI_UNIT"),
        currency_label.alias("CURRENCY_CODE"),
        F.col("stage_name").alias("RM_STAGE"),
        F.col("gate_plan_date").alias("G4_DueDate"),
        lit(None if pg_start is None else pg_start.year).cast("int").alias("PG_START_YEAR"),
        lit(None if pg_end is None else pg_end.year).cast("int").alias("PG_END_YEAR"),
        *[F.col(m) for m in ("Plan", "Update", "Actual", "Plan_To_Date", "Actual_To_Date", "Update_To_Date")],
        F.col("milestone_id").alias("A_FK_Milestone"),
        F.col("project_id").alias("A_FK_Project"),
        F.col("base_impact_id").alias("A_FK_BASE_IMPACT"),
        lit(pg_dice).cast("boolean").alias("A_DICE_ENABLED"),
        *[F.col(c) for c in NARRATIVE_COLUMNS],
        project_url(lit(p.program_id), F.col("pj_id"), F.col("parent_project_id")).alias("ProjectURL"),
        roadmap_url(lit(p.program_id), F.col("rm_id")).alias("RoadmapURL"),
    )
    assert out.columns == REPORT_COLUMNS, out.columns
    return out
