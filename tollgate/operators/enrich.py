"""Enrichment of valued milestone keys into report rows (labels, owners, status)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.functions.labels import person_name
from tollgate.functions.text import distinct_rows

# Role codes of the user-role table.
ROLE_WORKSTREAM_OWNER = 4
ROLE_ROADMAP_OWNER = 5
ROLE_ROADMAP_APPROVER = 6
# With folding, several holders of one role are listed in one cell, sorted.
HOLDER_SEPARATOR = "; "


def named_roles(user_role: DataFrame, users: DataFrame, roles: dict[int, str],
                text_collation: str | None = None) -> DataFrame:
    """(roadmap_id, project_id, role, holder): distinct holder names of the given roles
    (role code -> its key column), from one pass over the roles. A holder id with
    no user row gives ''."""
    wanted = F.lit(False)
    for role, key in roles.items():
        wanted = wanted | ((F.col("role") == role) & F.col(key).isNotNull())
    ur = user_role.where(wanted).select("roadmap_id", "project_id", "role", "user_id")
    named = ur.join(users.select("user_id", "last_name", "first_name"), "user_id", "left")
    name = person_name(F.col("last_name"), F.col("first_name"))
    return distinct_rows(named.select("roadmap_id", "project_id", "role", name.alias("holder")), text_collation)


def role_holders(named: DataFrame, role: int, key: str, fold: bool = False) -> DataFrame:
    """(key, holder) of one role: a row per distinct holder, as the source's joins give;
    with `fold`, one row per key that lists the holders."""
    holders = named.where((F.col("role") == role) & F.col(key).isNotNull()).select(key, "holder").distinct()
    if not fold:
        return holders
    return holders.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list("holder")), HOLDER_SEPARATOR).alias("holder"))


def owner_or_blank(holder_col: str) -> F.Column:
    """No holder at all -> '' (a NULL-tolerant concat of nothing)."""
    return F.coalesce(F.col(holder_col), F.lit(""))


def stage_gate(roadmap_view: DataFrame, roadmap_stage: DataFrame, gate_stage_id) -> DataFrame:
    """(roadmap_id, gate_plan_date): the gate stage's plan date, looked up through the
    roadmap view's key (no view row -> no gate date)."""
    gate = roadmap_stage.where(F.col("stage_id") == gate_stage_id).select(
        "roadmap_id", F.col("plan_date").alias("gate_plan_date")
    )
    return roadmap_view.select("roadmap_id").join(gate, "roadmap_id")
