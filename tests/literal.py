"""Literal forms of the source report's operators, for metamorphic checks.

These follow the source SQL step by step (six separate rate joins per impact row,
seven attribute joins) and are used only to check that the planned operators give
the same rows; they are not part of the report's plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.operators.attributes import NARRATIVE_ATTRIBUTES


def literal_valuation(t, p, keys):
    """The source's valuation, literally: keys x impact x factor x six rate joins."""
    imp = t.impact.where((F.col("program_id") == p.program_id) & (F.col("base_impact_id") == p.base_impact_id))
    j = keys.join(imp.drop("program_id", "milestone_id"), ["roadmap_id", "base_impact_id"], "left")
    fac = t.base_impact_factor.where(F.col("program_currency_id") == p.report_currency_id).select(
        "base_impact_id", "numeric_factor")
    j = j.join(fac, "base_impact_id", "left")
    dflt = F.lit(p.default_milestone_date)
    for k in ("plan", "actual", "forecast"):
        for tag, set_id in (("w", p.multiplier_set_id), ("t", p.multiplier_set_id_to_date)):
            m = t.multiplier_set_day.where(F.col("multiplier_set") == set_id).select(
                F.col("day").alias(f"{k}_{tag}_day"), F.col("program_currency_id").alias(f"{k}_{tag}_cur"),
                F.col("exchange_rate").alias(f"{k}_{tag}_ex"), F.col("financial_multiplier").alias(f"{k}_{tag}_fin"),
                F.col("multiplier").alias(f"{k}_{tag}_mul"))
            j = j.join(m, (F.coalesce(F.col(f"{k}_date"), dflt) == F.col(f"{k}_{tag}_day"))
                       & (F.col("program_currency_id") == F.col(f"{k}_{tag}_cur")), "left")
    return _grouped(j, p)


def _grouped(j, p):
    fin = F.col("financial") == True  # noqa: E712
    dflt = F.lit(p.default_milestone_date)
    aggs = []
    for k, td, name in (("plan", False, "Plan"), ("actual", False, "Actual"), ("forecast", False, "Update"),
                        ("plan", True, "Plan_To_Date"), ("actual", True, "Actual_To_Date"),
                        ("forecast", True, "Update_To_Date")):
        tag = "t" if td else "w"
        d = F.coalesce(F.col(f"{k}_date"), dflt)
        ot_end = p.calculation_date_as_of if td else p.one_time_end
        re_end = p.calculation_date_as_of if td else p.recurring_end
        ot = F.when(d.between(F.lit(p.one_time_start), F.lit(ot_end)),
                    F.col(f"{k}_intercept") * F.when(fin, F.col(f"{k}_{tag}_ex")).otherwise(F.lit(1)))
        re = F.when(d.between(F.lit(p.recurring_start), F.lit(re_end)),
                    F.col(f"{k}_slope") * F.when(fin, F.col(f"{k}_{tag}_fin")).otherwise(F.col(f"{k}_{tag}_mul")))
        aggs.append(F.sum(ot).cast("decimal(38,10)").alias(f"ot_{name}"))
        aggs.append(F.sum(re).cast("decimal(38,10)").alias(f"re_{name}"))
    g = j.groupBy("program_id", "project_id", "base_impact_id", "roadmap_id", "milestone_id", "numeric_factor").agg(*aggs)
    out = [c for c in ("program_id", "project_id", "base_impact_id", "roadmap_id", "milestone_id")]
    metrics = []
    per_year = F.lit(p.multiplier_per_year).cast("decimal(4,0)")
    for name in ("Plan", "Actual", "Update", "Plan_To_Date", "Actual_To_Date", "Update_To_Date"):
        ot, re = (F.coalesce(F.col(f"{half}_{name}"), F.lit(0)).cast("decimal(30,10)") for half in ("ot", "re"))
        metrics.append(((ot * per_year + re).cast("decimal(38,10)") / (per_year * F.col("numeric_factor")))
                       .cast("decimal(38,6)").alias(name))
    return g.select(*out, F.col("numeric_factor").cast("double").alias("numeric_factor"), *metrics)


def literal_attribute_joins(milestones: DataFrame, milestone_attribute: DataFrame) -> DataFrame:
    """One left join per narrative attribute, as the source writes it (fans out when
    a (milestone, attribute) pair repeats)."""
    out = milestones.select("milestone_id")
    for k, name in NARRATIVE_ATTRIBUTES.items():
        a = milestone_attribute.where(F.col("attribute_id") == k).select(
            F.col("milestone_id").alias(f"m{k}"), F.col("text_value").alias(name))
        out = out.join(a, out.milestone_id == F.col(f"m{k}"), "left").drop(f"m{k}")
    return out
