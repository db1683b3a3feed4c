"""Named queries: one per operator of the report, each over the whole test tables.

Every query takes (spark, sf_dir), derives the domain relations from the test
tables and returns a DataFrame; checks/oracle.py has the matching DuckDB SQL.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.functions.html import strip_html
from tollgate.functions.labels import (
    day_diff,
    person_name,
    project_url,
    roadmap_url,
    sentinel_datetime,
    traffic_light,
)
from tollgate.operators import cache as C
from tollgate.operators.asof import status_as_of, status_label
from tollgate.operators.attributes import NARRATIVE_COLUMNS, attribute_fanout, attribute_pivot
from tollgate.operators.bloom import BLOCK_BYTES
from tollgate.operators.enrich import (
    ROLE_ROADMAP_APPROVER,
    ROLE_ROADMAP_OWNER,
    ROLE_WORKSTREAM_OWNER,
    named_roles,
    owner_or_blank,
    role_holders,
    stage_gate,
)
from tollgate.operators.files import delete_folder, shuffles_freed
from tollgate.operators.filters import due_window
from tollgate.operators.hierarchy import tree_attributes, tree_path
from tollgate.operators.joins import NAMED_ROW_BYTES, broadcast_checked, scalar_lookup
from tollgate.operators.impact_totals import ImpactTotals
from tollgate.operators.ordering import with_ordinal
from tollgate.operators.requests import value_requests
from tollgate.operators.snapshots import StatusSnapshots
from tollgate.operators.tree_order import tree_order
from tollgate.operators.valuation import impact_rows_with_rates, metric_columns, stored_totals
from tollgate.params import DEFAULT_PARAMS, ImpactMode, ReportParams
from tollgate.plans.materialize import checkpoint_dir, materialize
from tollgate.plans.report import (
    KEY_COLUMNS,
    driving_set,
    filtered_milestones,
    report_rows,
    status_frames,
    valued_milestones,
)
from tollgate.sources.tables import Tables
from tollgate.sources.testdata import derive_tables

P = DEFAULT_PARAMS
P_UNSET = P.with_(impact_mode=ImpactMode.UNSET, base_impact_id=None)
P_NONE = P.with_(impact_mode=ImpactMode.NONE, base_impact_id=None)
# the source database's collation, and a base impact as someone types it
P_COLLATED = P.with_(text_collation="UNICODE_CI_RTRIM", base_impact_id="n3 ")
P_FACTOR = P.with_(numeric_factor=Decimal("2.5000"))
# projects whose cache rows a previous run already stored (the merge target)
# a previous run cached the needed projects of one market segment (snapshot id 8)
PRIOR_RUN_SNAPSHOT = 8
IMPACT_PARTS = 4  # parts in which the impact rows are derived before they are stored

# requests that differ in windows, sets, base impact, program, default date and horizon
REQUESTS = {
    1: P,
    2: P.with_(base_impact_id="N1", one_time_start=dt.date(1994, 3, 5), one_time_end=dt.date(1998, 2, 28),
               calculation_date_as_of=dt.date(1997, 7, 7), due_in_next_n_days=90),
    3: P.with_(multiplier_set_id=2, multiplier_set_id_to_date=1, default_milestone_date=dt.date(1996, 9, 30),
               include_one_time=False, multiplier_per_year=4),
    4: P.with_(program_id=2, base_impact_id="N9", numeric_factor=Decimal("2.5000"), recurring_start=dt.date(1999, 1, 1),
               recurring_end=dt.date(1998, 1, 1), filter_date_start=dt.date(1995, 1, 1)),
    5: P.with_(report_currency_id=0, default_milestone_date=dt.date(1990, 1, 1), today=dt.date(1998, 1, 1)),
}

FM_COLUMNS = [*KEY_COLUMNS, "milestone_name", "datedif", *NARRATIVE_COLUMNS]
METRIC_COLUMNS = ["Plan", "Actual", "Update", "Plan_To_Date", "Actual_To_Date", "Update_To_Date"]

Query = Callable[[SparkSession, str], DataFrame]


_TABLES: dict[tuple[int, str], tuple[SparkSession, Tables]] = {}


def _t(spark: SparkSession, sf_dir: str) -> Tables:
    """The derived domain relations of `sf_dir`, defined once per session.

    They are lazy plans, not data: every query still scans the parquet files and
    derives the relations it uses; only the Python-side plan building is shared.
    """
    key = (id(spark), sf_dir)
    hit = _TABLES.get(key)
    if hit is None or hit[0] is not spark:
        hit = (spark, derive_tables(spark, sf_dir))
        _TABLES[key] = hit
    return hit[1]


# ---- step 1: the slice ------------------------------------------------------

def milestone_due_window(spark, sf_dir):
    t = _t(spark, sf_dir)
    fr = t.filtered_roadmap.where(F.col("program_id") == P.program_id)
    ms = due_window(t.milestone, P)
    return fr.join(ms.drop("program_id"), "roadmap_id").select(
        "roadmap_id", "milestone_id", "project_id", "milestone_name", "plan_date", "forecast_date",
        day_diff(F.col("forecast_date"), F.lit(P.today)).alias("datedif"),
    )


def multiplier_lookup(spark, sf_dir):
    t = _t(spark, sf_dir)
    rows = impact_rows_with_rates(t.impact, t.multiplier_set_day, t.program_currency, P)
    dbl = ["intercept", "slope", "ex_w", "fin_w", "mul_w", "ex_t", "fin_t", "mul_t"]
    return rows.select(
        "roadmap_id", "base_impact_id", "program_currency_id", "financial", "kind", "d",
        *[F.col(c).cast("double").alias(c) for c in dbl],
    )


def _valued(t: Tables, p: ReportParams) -> DataFrame:
    return valued_milestones(t, p).withColumn("numeric_factor", F.col("numeric_factor").cast("double"))


def impact_rollup_plan(spark, sf_dir):
    return _valued(_t(spark, sf_dir), P).select(*KEY_COLUMNS, "numeric_factor", "Plan")


# ---- step 2: valuation ------------------------------------------------------

def _mode(p: ReportParams) -> Query:
    def q(spark, sf_dir):
        return filtered_milestones(_t(spark, sf_dir), p).select(*FM_COLUMNS)
    return q


def distinct_keys(spark, sf_dir):
    return filtered_milestones(_t(spark, sf_dir), P).select(*KEY_COLUMNS).distinct()


def impact_rollup(spark, sf_dir):
    return _valued(_t(spark, sf_dir), P).select(*KEY_COLUMNS, "numeric_factor", *METRIC_COLUMNS)


def numeric_factor(spark, sf_dir):
    return _valued(_t(spark, sf_dir), P_FACTOR).select(*KEY_COLUMNS, "numeric_factor", *METRIC_COLUMNS)


def impact_rollup_stored(spark, sf_dir):
    """The rollup from the stored impact view. Its first load has too much and too little:
    non-financial rows are missing, financial ones have their plan off by one, and the rows of the
    first currency are there twice; three batches of changes put that right."""
    t = _t(spark, sf_dir)
    folder = f"{checkpoint_dir(spark)}/impact-{uuid.uuid4()}"
    # the changes are taken from the impact rows four times: derived and joined once (totals have no milestone),
    # a part of the roadmaps at a time, whose shuffle files go before the next part's come
    part = F.pmod(F.xxhash64("roadmap_id"), F.lit(IMPACT_PARTS))
    with shuffles_freed(spark):
        for i in range(IMPACT_PARTS):
            t.impact.where(part == i).drop("milestone_id").write.mode("append").option("compression", "zstd").parquet(f"{folder}/rows")
    impact = spark.read.parquet(f"{folder}/rows")
    view = ImpactTotals(spark, f"{folder}/view")
    financial = impact.where("financial")
    wrong = financial.withColumn("plan_intercept", (F.col("plan_intercept") + 1).cast("decimal(19,4)"))
    first_currency = impact.where("program_currency_id = 0")

    def signed(df: DataFrame, sign: int) -> DataFrame:
        return df.withColumn("sign", F.lit(sign))

    view.load(wrong.unionByName(first_currency))
    view.apply(signed(impact.where("not financial"), 1), 1)
    view.apply(signed(wrong, -1).unionByName(signed(financial, 1)), 2)
    first, view = view, view.compact()
    first.drop()
    view.apply(signed(first_currency, -1), 1)
    delete_folder(spark, f"{folder}/rows")
    base, _ = driving_set(t, P)
    totals = stored_totals(view.read(), t.multiplier_set_day, t.program_currency, t.base_impact_factor, P)
    return base.select(*KEY_COLUMNS).join(totals, "roadmap_id", "left").select(
        *KEY_COLUMNS, F.col("numeric_factor").cast("double").alias("numeric_factor"), *metric_columns(P))


def impact_rollup_requests(spark, sf_dir):
    """Several requests valued in one pass over the impacts."""
    rows = value_requests(_t(spark, sf_dir), REQUESTS)
    return rows.withColumn("numeric_factor", F.col("numeric_factor").cast("double"))


# ---- step 3: status history -------------------------------------------------

def _status(days: int) -> Query:
    def q(spark, sf_dir):
        t = _t(spark, sf_dir)
        base, bounds = driving_set(t, P_UNSET)
        return status_as_of(t.roadmap_audit, base.select("roadmap_id"), P.status_as_of, days,
                            n_roadmaps=bounds["roadmap_id"])
    return q


def status_asof_bloom(spark, sf_dir):
    """The status 14 days ago with a broadcast budget too small for the keys: a Bloom filter of
    half their size cuts the history inside its scan, before the exact join shuffles the rest."""
    t = _t(spark, sf_dir)
    base, bounds = driving_set(t, P_UNSET)
    bound = bounds["roadmap_id"]
    return status_as_of(t.roadmap_audit, base.select("roadmap_id"), P.status_as_of, 14, n_roadmaps=bound,
                        budget=max(BLOCK_BYTES, bound.rows * bound.row_bytes // 2))


def status_asof_snapshot(spark, sf_dir):
    """The status 14 days ago from a growing history: one batch, a snapshot, a late batch, another
    snapshot, one more late batch; read are the last snapshot, the rows since and the last batch."""
    t = _t(spark, sf_dir)
    history = StatusSnapshots(spark, f"{checkpoint_dir(spark)}/history-{uuid.uuid4()}")
    audit, light = t.roadmap_audit, F.coalesce("traffic_light", F.lit(0))
    history.add(audit.where(light < 4))
    history.take(P.status_as_of - dt.timedelta(days=17))
    history.add(audit.where(light == 4))
    history.take(P.status_as_of - dt.timedelta(days=15))
    history.add(audit.where(light > 4))
    base, bounds = driving_set(t, P_UNSET)
    return history.status_as_of(P.status_as_of, 14, base.select("roadmap_id"), bounds["roadmap_id"])


def status_asof_ties(spark, sf_dir):
    t = _t(spark, sf_dir)
    audit = t.roadmap_audit.withColumn("audit_time", F.date_trunc("day", "audit_time").cast("timestamp_ntz"))
    return status_as_of(audit, None, P.status_as_of, 14)


def status_trend(spark, sf_dir):
    t = _t(spark, sf_dir)
    rows = filtered_milestones(t, P_UNSET)
    roadmaps = rows.select("roadmap_id").distinct()
    s14, s7 = status_frames(t, P_UNSET, roadmaps)
    return (
        roadmaps.join(status_label(s14).withColumnRenamed("label", "l14"), "roadmap_id", "left")
        .join(status_label(s7).withColumnRenamed("label", "l7"), "roadmap_id", "left")
        .select("roadmap_id", F.coalesce("l14", F.lit("Red")).alias("Status_2Weeks_ago"),
                F.coalesce("l7", F.lit("Red")).alias("Status_1Weeks_ago"))
    )


# ---- step 4: hierarchy ------------------------------------------------------

def q_tree_path(spark, sf_dir):
    return tree_path(spark, _t(spark, sf_dir).base_impact, P.program_id)


def q_tree_attributes(spark, sf_dir):
    return tree_attributes(spark, _t(spark, sf_dir).base_impact, P.program_id)


def tree_sorted(spark, sf_dir):
    """Base impacts in dropdown order: each one's position in the list sorted by
    sort path (ties broken by id)."""
    attrs = tree_attributes(spark, _t(spark, sf_dir).base_impact, P.program_id)
    return with_ordinal(attrs, ["BaseImpactPath", "BaseImpactID"], "PathPosition")


def q_tree_order(spark, sf_dir):
    return tree_order(spark, _t(spark, sf_dir).base_impact, P.program_id)


# ---- step 5: attributes -----------------------------------------------------

def attr_pivot(spark, sf_dir):
    return attribute_pivot(_t(spark, sf_dir).milestone_attribute)


def attr_join_fanout(spark, sf_dir):
    """How many rows the source's seven attribute joins give per milestone, and the values they are made of."""
    t = _t(spark, sf_dir)
    return _listed(attribute_fanout(t.milestone_attribute, t.milestone))


def _listed(fan: DataFrame) -> DataFrame:
    def listed(name: str) -> F.Column:
        return F.array_join(F.transform(name, lambda x: F.concat(x["value"], F.lit(" x"), x["times"].cast("string"))), " | ").alias(name)

    return fan.select("milestone_id", F.col("literal_rows").cast("bigint").alias("literal_rows"),
                      F.col("distinct_rows").cast("bigint").alias("distinct_rows"), *[listed(c) for c in NARRATIVE_COLUMNS])


def null_key_join(spark, sf_dir):
    """Keys joined to the milestone set on (roadmap, milestone, base impact) with plain
    equality, where every other milestone has a NULL base impact: those match nothing."""
    t = _t(spark, sf_dir)
    fm = filtered_milestones(t, P_UNSET).withColumn(
        "base_impact_id", F.when(F.col("milestone_id") % 2 == 0, F.lit(P.base_impact_id)))
    keys = fm.select(*KEY_COLUMNS).distinct()
    narr = fm.select(
        F.col("roadmap_id").alias("n_roadmap_id"), F.col("milestone_id").alias("n_milestone_id"),
        F.col("base_impact_id").alias("n_base_impact_id"), *NARRATIVE_COLUMNS,
    )
    cond = ((keys.roadmap_id == narr.n_roadmap_id) & (keys.milestone_id == narr.n_milestone_id)
            & (keys.base_impact_id == narr.n_base_impact_id))
    return keys.join(narr, cond, "left").select(*KEY_COLUMNS, *NARRATIVE_COLUMNS)


# ---- step 6: labels ---------------------------------------------------------

def q_traffic_light(spark, sf_dir):
    rv = _t(spark, sf_dir).roadmap_view
    return rv.select(
        "roadmap_id",
        traffic_light(F.col("tl_dice")).alias("RM_TL_DICE"),
        traffic_light(F.col("tl_milestone")).alias("RM_TL_MS"),
        traffic_light(F.col("tl_impact")).alias("RM_TL_IM"),
        traffic_light(F.col("tl_overall")).alias("RM_TL_OVERALL"),
    )


def owner_name(spark, sf_dir):
    t = _t(spark, sf_dir)
    return t.user_role.join(t.users, "user_id", "left").select(
        "roadmap_id", "project_id", "role", "user_id",
        person_name(F.col("last_name"), F.col("first_name")).alias("owner_name"),
    )


def q_sentinel_date(spark, sf_dir):
    rs = _t(spark, sf_dir).roadmap_stage
    return rs.select("roadmap_id", "stage_id", "plan_date", sentinel_datetime(F.col("plan_date")).alias("G4_DueDate"))


def delay_days(spark, sf_dir):
    return _t(spark, sf_dir).milestone.select(
        "milestone_id",
        day_diff(F.col("plan_date"), F.lit(P.today)).alias("DELAY_OVERDUE"),
        day_diff(F.col("forecast_date"), F.lit(P.today)).alias("datedif"),
        sentinel_datetime(F.col("update_date")).alias("A_Forecast"),
    )


def year_columns(spark, sf_dir):
    """Program start / end year and DICE flag per project, through its program."""
    t = _t(spark, sf_dir)
    pg = broadcast_checked(t.program.select("program_id", "start_date", "end_date", "dice_enabled"), NAMED_ROW_BYTES)
    return t.project.join(pg, "program_id", "left").select(
        "project_id", "program_id", F.year("start_date").alias("PG_START_YEAR"),
        F.year("end_date").alias("PG_END_YEAR"), F.col("dice_enabled").alias("A_DICE_ENABLED"))


def url_build(spark, sf_dir):
    t = _t(spark, sf_dir)
    fr = t.filtered_roadmap
    pj = t.project.select("project_id", F.col("project_id").alias("pj_id"), "parent_project_id")
    rm = t.roadmap.select("roadmap_id", F.col("roadmap_id").alias("rm_id"))
    j = fr.join(pj, "project_id", "left").join(rm, "roadmap_id", "left")
    return j.select(
        "roadmap_id", "project_id",
        project_url(F.col("program_id"), F.col("pj_id"), F.col("parent_project_id")).alias("ProjectURL"),
        roadmap_url(F.col("program_id"), F.col("rm_id")).alias("RoadmapURL"),
    )


def html_text(spark, sf_dir):
    return _t(spark, sf_dir).roadmap.select("roadmap_id", strip_html(F.col("description")).alias("ROADMAP_DESCRIPTION"))


def currency_lookup(spark, sf_dir):
    t = _t(spark, sf_dir)
    code = scalar_lookup(
        t.program_currency.where(F.col("program_currency_id") == P.report_currency_id).join(t.currency, "currency_id"),
        "code",
    )
    return t.base_impact.select(
        "base_impact_id",
        F.when(F.col("financial") == True, F.lit(code)).otherwise(F.lit("")).alias("CURRENCY_CODE"),  # noqa: E712
    )


# ---- step 7: enrichment -----------------------------------------------------

def role_owner(spark, sf_dir):
    """One row per roadmap and combination of its role holders."""
    t = _t(spark, sf_dir)
    named = named_roles(t.user_role, t.users, {
        ROLE_WORKSTREAM_OWNER: "project_id", ROLE_ROADMAP_OWNER: "roadmap_id", ROLE_ROADMAP_APPROVER: "roadmap_id"})
    o = role_holders(named, ROLE_ROADMAP_OWNER, "roadmap_id").withColumnRenamed("holder", "o")
    a = role_holders(named, ROLE_ROADMAP_APPROVER, "roadmap_id").withColumnRenamed("holder", "a")
    w = role_holders(named, ROLE_WORKSTREAM_OWNER, "project_id").withColumnRenamed("holder", "w")
    fr = t.filtered_roadmap.select("roadmap_id", "project_id")
    j = fr.join(o, "roadmap_id", "left").join(a, "roadmap_id", "left").join(w, "project_id", "left")
    return j.select("roadmap_id", "project_id", owner_or_blank("o").alias("RM_OWNER"),
                    owner_or_blank("a").alias("RM_APPROVER"), owner_or_blank("w").alias("WS_OWNER"))


def q_stage_gate(spark, sf_dir):
    t = _t(spark, sf_dir)
    gate = stage_gate(t.roadmap_view, t.roadmap_stage, P.gate_stage_id)
    rm = t.roadmap.select("roadmap_id", "stage_id")
    return (
        rm.join(t.stage, "stage_id", "left").join(gate, "roadmap_id", "left")
        .select("roadmap_id", F.col("stage_name").alias("RM_STAGE"),
                sentinel_datetime(F.col("gate_plan_date")).alias("G4_DueDate"))
    )


def star_enrichment(spark, sf_dir):
    return report_rows(_t(spark, sf_dir), P_UNSET)


def report_result(spark, sf_dir):
    return report_rows(_t(spark, sf_dir), P)


def report_mode_none(spark, sf_dir):
    """The report for roadmaps without any impact (the "none" base impact)."""
    return report_rows(_t(spark, sf_dir), P_NONE)


def _spelled(t: Tables) -> Tables:
    """The relations as people type them: keys, attribute values and holders in other letter
    cases and with trailing blanks, some of them beside the first spelling."""
    def other(key: str) -> Column:
        return F.concat(F.lower(key), F.lit("  "))

    eav, users, role = t.milestone_attribute, t.users, t.user_role
    again = eav.withColumn("text_value", other("text_value"))
    alias = F.lit(10**12)  # ids of the holders' second accounts
    return t.replace(
        impact=t.impact.withColumn("base_impact_id", F.when(F.col("financial"), other("base_impact_id")).otherwise(F.col("base_impact_id"))),
        base_impact=t.base_impact.withColumn("parent_id", F.when(F.col("timing") == 2, other("parent_id")).otherwise(F.col("parent_id")))
        .withColumn("base_impact_id", F.when(F.col("calculated"), F.lower("base_impact_id")).otherwise(F.col("base_impact_id"))),
        base_impact_factor=t.base_impact_factor.withColumn("base_impact_id", F.concat("base_impact_id", F.lit(" "))),
        milestone_attribute=eav.unionByName(again),
        users=users.unionByName(users.withColumn("user_id", F.col("user_id") + alias).withColumn("last_name", F.lower("last_name"))),
        user_role=role.unionByName(role.withColumn("user_id", F.col("user_id") + alias)),
    )


def report_collated(spark, sf_dir):
    """The report under the source database's collation, over keys in many spellings."""
    return report_rows(_spelled(_t(spark, sf_dir)), P_COLLATED)


def impact_rollup_collated(spark, sf_dir):
    return _valued(_spelled(_t(spark, sf_dir)), P_COLLATED).select(*KEY_COLUMNS, "numeric_factor", *METRIC_COLUMNS)


def tree_attributes_collated(spark, sf_dir):
    """Parents and children in different spellings; the result's ids in one."""
    attrs = tree_attributes(spark, _spelled(_t(spark, sf_dir)).base_impact, P.program_id, P_COLLATED.text_collation)
    return attrs.select(*[F.rtrim(F.lower(c)).alias(c) if c in ("BaseImpactID", "BaseImpactParentBaseImpactID") else F.col(c)
                          for c in attrs.columns])


def attr_fanout_collated(spark, sf_dir):
    t = _spelled(_t(spark, sf_dir))
    return _listed(attribute_fanout(t.milestone_attribute, t.milestone, text_collation=P_COLLATED.text_collation))


# ---- step 8: cache ----------------------------------------------------------

def exists_gate(spark, sf_dir):
    """The request's projects with the gate: is any snapshot needed at all? (EXISTS: one row
    is enough to answer it.)"""
    t = _t(spark, sf_dir)
    return t.snapshot_in_report.select("project_id", F.lit(not t.snapshot_needed.isEmpty()).alias("gate_open"))


def _cache_parts(t: Tables, p: ReportParams) -> tuple[DataFrame, DataFrame]:
    """(rows this run computes, the target table a previous run left).

    The previous run stored the rows of a subset of the needed projects; since a
    project's rows depend on that project only, they are the same rows, so the
    report is computed once and stored once for both."""
    needed = t.snapshot_needed
    prior_needed = needed.where(F.col("snapshot_id") == PRIOR_RUN_SNAPSHOT)
    report = materialize(report_rows(t, p, projects=needed))
    target = C.cache_rows(report.join(prior_needed.select(F.col("project_id").alias("A_FK_Project")),
                                      "A_FK_Project", "left_semi"), prior_needed, p)
    new_rows = C.cache_rows(report, needed, p)
    return new_rows, target


def cache_insert_if_absent(spark, sf_dir):
    new_rows, target = _cache_parts(_t(spark, sf_dir), P)
    return C.rows_to_insert(new_rows, target).select(*C.CACHE_COLUMNS)


def cache_null_key_reinsert(spark, sf_dir):
    new_rows, target = _cache_parts(_t(spark, sf_dir), P_UNSET)
    return C.rows_to_insert(new_rows, target).select(*C.CACHE_COLUMNS)


def cache_after_merge(spark, sf_dir):
    new_rows, target = _cache_parts(_t(spark, sf_dir), P)
    return C.merged(new_rows, target)


def cached_project_markers(spark, sf_dir):
    return C.markers(_t(spark, sf_dir).snapshot_needed, P).drop("marked_at")


def cache_read_back(spark, sf_dir):
    t = _t(spark, sf_dir)
    new_rows, target = _cache_parts(t, P)
    return C.read_back(C.merged(new_rows, target), t.snapshot_in_report, P)


def cache_stored_read_back(spark, sf_dir):
    """The read-back from cache files, after two merges into them (the second run's rows meet the
    first one's), as a request reads them."""
    t = _t(spark, sf_dir)
    new_rows, target = _cache_parts(t, P)
    cache = C.ReportCache(spark, f"{checkpoint_dir(spark)}/cache-{uuid.uuid4()}")
    cache.merge(target, P, t.snapshot_needed.where(F.col("snapshot_id") == PRIOR_RUN_SNAPSHOT))
    cache.merge(new_rows, P, t.snapshot_needed)
    return cache.read_back(t.snapshot_in_report, P)


def final_report(spark, sf_dir):
    t = _t(spark, sf_dir)
    new_rows, target = _cache_parts(t, P)
    rows = C.read_back(C.merged(new_rows, target), t.snapshot_in_report, P)
    return C.with_tree_position(rows, t.tree)


QUERIES: dict[str, Query] = {
    "milestone_due_window": milestone_due_window,
    "multiplier_lookup": multiplier_lookup,
    "impact_rollup_plan": impact_rollup_plan,
    "impact_mode_selected": _mode(P),
    "impact_mode_unset": _mode(P_UNSET),
    "impact_mode_none": _mode(P_NONE),
    "distinct_keys": distinct_keys,
    "numeric_factor": numeric_factor,
    "impact_rollup": impact_rollup,
    "impact_rollup_stored": impact_rollup_stored,
    "impact_rollup_requests": impact_rollup_requests,
    "status_asof_7": _status(7),
    "status_asof_14": _status(14),
    "status_asof_bloom": status_asof_bloom,
    "status_asof_snapshot": status_asof_snapshot,
    "status_asof_ties": status_asof_ties,
    "status_trend": status_trend,
    "tree_path": q_tree_path,
    "tree_attributes": q_tree_attributes,
    "tree_sorted": tree_sorted,
    "tree_order": q_tree_order,
    "attr_pivot": attr_pivot,
    "attr_join_fanout": attr_join_fanout,
    "null_key_join": null_key_join,
    "traffic_light": q_traffic_light,
    "owner_name": owner_name,
    "sentinel_date": q_sentinel_date,
    "delay_days": delay_days,
    "year_columns": year_columns,
    "url_build": url_build,
    "html_text": html_text,
    "currency_lookup": currency_lookup,
    "role_owner": role_owner,
    "stage_gate": q_stage_gate,
    "star_enrichment": star_enrichment,
    "report_result": report_result,
    "report_mode_none": report_mode_none,
    "report_collated": report_collated,
    "impact_rollup_collated": impact_rollup_collated,
    "tree_attributes_collated": tree_attributes_collated,
    "attr_fanout_collated": attr_fanout_collated,
    "exists_gate": exists_gate,
    "cache_insert_if_absent": cache_insert_if_absent,
    "cache_null_key_reinsert": cache_null_key_reinsert,
    "cache_after_merge": cache_after_merge,
    "cached_project_markers": cached_project_markers,
    "cache_read_back": cache_read_back,
    "cache_stored_read_back": cache_stored_read_back,
    "final_report": final_report,
}
