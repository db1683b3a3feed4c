"""Impact valuation: six metrics per milestone key (plan, actual, forecast, each in
the report window and to date), with per-day rates from two multiplier sets.

Plan, in Spark terms:
  1. the multiplier table, cut to the days any window can reach and to the two
     sets, is pivoted to one row per (day, currency) with both sets' rates. Its
     size is bounded by days x currencies, checked before it is broadcast;
  2. each impact row is unpivoted into its three dated measures (plan, actual,
     forecast) and looks its rates up in ONE broadcast hash join;
  3. the base-impact factor is one value when a base impact is picked (else a
     checked broadcast lookup), so the rows are aggregated once, by (roadmap,
     factor), with map-side partial sums before the shuffle;
  4. the roadmap totals are joined to the milestone keys (a roadmap's total
     repeats for each of its milestones) and turned into the six metrics.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.operators.joins import (
    NAMED_ROW_BYTES,
    WIDE_ROW_BYTES,
    KeyBound,
    broadcast_checked,
    broadcast_if_bounded,
    key_bounds,
    scalar_lookup,
    semi_join_keys,
)
from tollgate.params import ImpactMode, ReportParams

if TYPE_CHECKING:  # imported for annotations only (plans depend on operators)
    from tollgate.plans.constants import RequestConstants
    from tollgate.sources.tables import Tables

KINDS = ("plan", "actual", "forecast")
# metric column -> (date kind, to-date?)
METRICS = {
    "Plan": ("plan", False),
    "Actual": ("actual", False),
    "Update": ("forecast", False),
    "Plan_To_Date": ("plan", True),
    "Actual_To_Date": ("actual", True),
    "Update_To_Date": ("forecast", True),
}
# decimal(19,4) measures times decimal(18,6) rates: sums keep every digit
SUM_TYPE = "decimal(38,10)"
# the metrics; beyond 20 digits before the point a sum raises instead of losing digits
METRIC_TYPE = "decimal(38,6)"


def multiplier_rates(multiplier_set_day: DataFrame, program_currency: DataFrame, p: ReportParams,
                     n_currencies: int | None = None) -> DataFrame:
    """(day, program_currency_id, ex_w, fin_w, mul_w, ex_t, fin_t, mul_t): window-set
    (w) and to-date-set (t) rates, one row per day and currency, for the days the
    valuation windows cover. Precondition: (day, currency, set) is unique."""
    lo, hi = p.valuation_date_range
    sw, st = p.multiplier_set_id, p.multiplier_set_id_to_date
    m = multiplier_set_day.where(
        (F.col("day") >= F.lit(lo)) & (F.col("day") <= F.lit(hi))
        & F.col("multiplier_set").isin(sw, st)
    )

    def pick(set_id: int, col: str) -> Column:
        return F.max(F.when(F.col("multiplier_set") == set_id, F.col(col)))

    def rows_of(set_id: int) -> Column:
        return F.count(F.when(F.col("multiplier_set") == set_id, F.lit(1)))

    rates = m.groupBy("day", "program_currency_id").agg(
        pick(sw, "exchange_rate").alias("ex_w"),
        pick(sw, "financial_multiplier").alias("fin_w"),
        pick(sw, "multiplier").alias("mul_w"),
        pick(st, "exchange_rate").alias("ex_t"),
        pick(st, "financial_multiplier").alias("fin_t"),
        pick(st, "multiplier").alias("mul_t"),
        rows_of(sw).alias("_n_w"),
        rows_of(st).alias("_n_t"),
    )
    # a repeated (day, currency, set) would make the sums ambiguous: fail the job
    # (checked inside the plan, no extra pass over the data)
    # (on the join key: no setting prunes it away)
    dup = (F.col("_n_w") > 1) | ((F.col("_n_t") > 1) & F.lit(sw != st))
    rates = rates.withColumn(
        "day", F.when(dup, F.raise_error(F.lit("multiplier_set_day repeats a (day, currency, set)")).cast(
            "date")).otherwise(F.col("day"))
    ).drop("_n_w", "_n_t")
    # bound: one row per (day, currency); the currency count is a small dimension
    n_cur = program_currency.count() if n_currencies is None else n_currencies
    days = (hi - lo).days + 1
    return broadcast_if_bounded(rates, days * n_cur, WIDE_ROW_BYTES)


def unpivot_dates(impact: DataFrame, p: ReportParams) -> DataFrame:
    """(roadmap_id, base_impact_id, program_currency_id, financial, kind, d, intercept,
    slope): three rows per impact; a NULL date falls back to the default date."""
    default = F.lit(p.default_milestone_date)
    parts = F.array(*[
        F.struct(
            F.lit(k).alias("kind"),
            F.coalesce(F.col(f"{k}_date"), default).alias("d"),
            F.col(f"{k}_intercept").alias("intercept"),
            F.col(f"{k}_slope").alias("slope"),
        )
        for k in KINDS
    ])
    return impact.select(
        "roadmap_id", "base_impact_id", "program_currency_id", "financial",
        F.inline(parts),
    )


def _between(d: Column, lo, hi) -> Column:
    return (d >= F.lit(lo)) & (d <= F.lit(hi))


def impact_rows_with_rates(impact: DataFrame, multiplier_set_day: DataFrame,
                           program_currency: DataFrame, p: ReportParams,
                           n_currencies: int | None = None) -> DataFrame:
    """Unpivoted impact rows of the program (and picked base impact) with both
    sets' rates; a missing rate row leaves the rates NULL."""
    imp = impact.where(F.col("program_id") == p.program_id)
    if p.impact_mode is ImpactMode.SELECTED:
        imp = imp.where(F.col("base_impact_id") == p.base_impact_id)
    return with_rates(unpivot_dates(imp, p), multiplier_set_day, program_currency, p, n_currencies)


def with_rates(rows: DataFrame, multiplier_set_day: DataFrame, program_currency: DataFrame, p: ReportParams,
               n_currencies: int | None = None) -> DataFrame:
    """Dated measures with both sets' rates of their day and currency."""
    rates = multiplier_rates(multiplier_set_day, program_currency, p, n_currencies)
    return rows.join(
        rates,
        (rows.d == rates.day) & (rows.program_currency_id == rates.program_currency_id),
        "left",
    ).drop(rates.program_currency_id).drop("day")


def _contributions(p: ReportParams) -> dict[str, Column]:
    """Per unpivoted row: the four values it adds to its kind's sums (NULL = none)."""
    d = F.col("d")
    fin = F.col("financial") == True  # noqa: E712  (NULL -> not financial)
    one = F.lit(1)
    ot_w = F.col("intercept") * F.when(fin, F.col("ex_w")).otherwise(one)
    re_w = F.col("slope") * F.when(fin, F.col("fin_w")).otherwise(F.col("mul_w"))
    ot_t = F.col("intercept") * F.when(fin, F.col("ex_t")).otherwise(one)
    re_t = F.col("slope") * F.when(fin, F.col("fin_t")).otherwise(F.col("mul_t"))
    null = F.lit(None).cast(SUM_TYPE)
    return {
        "ot_w": F.when(_between(d, p.one_time_start, p.one_time_end), ot_w) if p.include_one_time else null,
        "re_w": F.when(_between(d, p.recurring_start, p.recurring_end), re_w) if p.include_recurring else null,
        "ot_t": F.when(_between(d, p.one_time_start, p.calculation_date_as_of), ot_t) if p.include_one_time else null,
        "re_t": F.when(_between(d, p.recurring_start, p.calculation_date_as_of), re_t) if p.include_recurring else null,
    }


def partial_sum_columns() -> list[str]:
    return [f"{half}_{m}" for m in METRICS for half in ("ot", "re")]


def roadmap_totals(impact: DataFrame, multiplier_set_day: DataFrame, program_currency: DataFrame,
                   base_impact_factor: DataFrame, p: ReportParams,
                   consts: RequestConstants | None = None) -> DataFrame:
    """(roadmap_id, numeric_factor, ot_<metric>, re_<metric> for 6 metrics): exact
    decimal sums of each half of each metric, per roadmap and factor."""
    rows = impact_rows_with_rates(impact, multiplier_set_day, program_currency, p,
                                  None if consts is None else consts.n_currencies)
    return summed(rows, base_impact_factor, p, consts)


def stored_totals(totals: DataFrame, multiplier_set_day: DataFrame, program_currency: DataFrame,
                  base_impact_factor: DataFrame, p: ReportParams) -> DataFrame:
    """As `roadmap_totals`, from stored daily totals (operators/impact_totals.py): the measures of
    a day share their rates, so the day's total is valued at once. A total of a day has up to
    15 digits before the point; beyond that the cast raises."""
    rows = totals.where(F.col("program_id") == p.program_id)
    if p.impact_mode is ImpactMode.SELECTED:
        rows = rows.where(F.col("base_impact_id") == p.base_impact_id)
    rows = rows.select(
        "roadmap_id", "base_impact_id", "program_currency_id", "financial", "kind",
        F.coalesce("d", F.lit(p.default_milestone_date)).alias("d"),
        F.col("intercept").cast("decimal(19,4)").alias("intercept"), F.col("slope").cast("decimal(19,4)").alias("slope"))
    return summed(with_rates(rows, multiplier_set_day, program_currency, p), base_impact_factor, p)


def summed(rows: DataFrame, base_impact_factor: DataFrame, p: ReportParams,
           consts: RequestConstants | None = None) -> DataFrame:
    """The sums of `roadmap_totals` over dated measures with rates."""
    factor = base_impact_factor.where(F.col("program_currency_id") == p.report_currency_id)
    if p.impact_mode is ImpactMode.SELECTED:
        # one base impact and one currency: the factor is a single value
        value = (scalar_lookup(factor.where(F.col("base_impact_id") == p.base_impact_id), "numeric_factor")
                 if consts is None else consts.factor)
        rows = rows.withColumn("numeric_factor", F.lit(value).cast("decimal(19,4)"))
    else:
        rows = rows.join(broadcast_checked(factor.select("base_impact_id", "numeric_factor"), NAMED_ROW_BYTES),
                         "base_impact_id", "left")
    c = _contributions(p)
    sums = []
    for metric, (kind, to_date) in METRICS.items():
        sfx = "t" if to_date else "w"
        is_kind = F.col("kind") == kind
        sums += [F.sum(F.when(is_kind, c[f"{half}_{sfx}"].cast(SUM_TYPE))).alias(f"{half}_{metric}") for half in ("ot", "re")]
    return rows.groupBy("roadmap_id", "numeric_factor").agg(*sums)


def metric_columns(p: ReportParams) -> list[Column]:
    """(ISNULL(one-time sum, 0) + ISNULL(recurring sum / per-year, 0)) / factor,
    where factor is the numeric-factor parameter if given, else the base impact's.

    Both halves are exact decimal sums; one decimal division of (one-time sum *
    per-year + recurring sum) by (per-year * factor) gives the metric, rounded half up to
    six decimals. The result does not depend on the order rows were summed in."""
    per_year = F.lit(p.multiplier_per_year).cast("decimal(4,0)")
    if p.numeric_factor is not None:
        factor = F.lit(p.numeric_factor).cast("decimal(19,4)")
    else:
        factor = F.col("numeric_factor")
    zero = F.lit(0).cast(SUM_TYPE)
    out = []
    for metric in METRICS:
        # the narrower types keep the product's and the sum's ten decimals
        ot = F.coalesce(F.col(f"ot_{metric}"), zero).cast("decimal(30,10)") * per_year
        re = F.coalesce(F.col(f"re_{metric}"), zero).cast("decimal(34,10)")
        out.append(((ot + re).cast(SUM_TYPE) / (per_year * factor)).cast(METRIC_TYPE).alias(metric))
    return out


def value_keys(keys: DataFrame, tables: Tables, p: ReportParams, consts: RequestConstants | None = None,
               n_roadmaps: KeyBound | None = None) -> DataFrame:
    """keys + numeric_factor + the six metrics.

    A key gets one row per distinct factor among its roadmap's impacts, or one
    row with NULL sums when nothing matches (its metrics are then 0 / factor).
    SELECTED values the picked base impact's rows. The keys of NONE have no impact by
    definition and UNSET matches none, so no impact is read for them.
    """
    if p.impact_mode is ImpactMode.SELECTED:
        # only the keys' roadmaps are valued: the impact rows of other roadmaps are
        # dropped before anything else happens to them
        bound = n_roadmaps or key_bounds(keys, "roadmap_id")["roadmap_id"]
        impact = semi_join_keys(tables.impact, keys, "roadmap_id", bound)
        totals = roadmap_totals(impact, tables.multiplier_set_day, tables.program_currency,
                                tables.base_impact_factor, p, consts)
        joined = keys.join(totals, "roadmap_id", "left")
    else:
        joined = keys.select(
            "*", F.lit(None).cast("decimal(19,4)").alias("numeric_factor"),
            *[F.lit(None).cast(SUM_TYPE).alias(c) for c in partial_sum_columns()],
        )
    keep = [c for c in keys.columns]
    return joined.select(*keep, "numeric_factor", *metric_columns(p))
