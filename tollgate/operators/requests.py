"""Many valuation requests in one pass: windows as rows, cut points merged, prefix sums.

Each request has its own windows, multiplier sets, picked base impact, default date and due
horizon. Valued one by one, each reads the impact rows. Here

1. the ends of all windows cut time into segments (the same for every request);
2. impact rows become daily totals, valued once per multiplier set that some request names, and
   summed per roadmap, base impact, set, kind and segment: one pass over the impact rows;
3. running sums over the segments make a list per series, so the sum of any window is
   the difference of two of its elements, whatever the number of requests;
4. the requests, a small broadcast relation, pick their series and elements.

Impact rows without a date fall on a request's default date: they form a series of their own
per distinct default date. Sums are exact decimals, so the metrics are those of one request at a time.
Requests pick a base impact (mode SELECTED); the other modes read no impact rows.
"""

from __future__ import annotations

import datetime as dt
from bisect import bisect_right

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tollgate.operators.impact_totals import full_totals
from tollgate.operators.joins import broadcast_if_bounded, fits_broadcast
from tollgate.operators.valuation import METRIC_TYPE, METRICS, SUM_TYPE
from tollgate.params import ImpactMode, ReportParams

DAY = dt.timedelta(days=1)
REQUEST_BYTES = 512
RATE_BYTES = 96


def _windows(p: ReportParams) -> dict[str, tuple[dt.date, dt.date, bool]]:
    """(first day, last day, counted?) of each half (one-time, recurring), in the window and to date."""
    return {
        "ot_w": (p.one_time_start, p.one_time_end, p.include_one_time),
        "re_w": (p.recurring_start, p.recurring_end, p.include_recurring),
        "ot_t": (p.one_time_start, p.calculation_date_as_of, p.include_one_time),
        "re_t": (p.recurring_start, p.calculation_date_as_of, p.include_recurring),
    }


def cut_points(requests: dict[int, ReportParams]) -> list[dt.date]:
    """Days on which some window starts, or the day after it ends, in order."""
    return sorted({day for p in requests.values() for a, b, counted in _windows(p).values() if counted and a <= b
                   for day in (a, b + DAY)})


def request_rows(spark: SparkSession, requests: dict[int, ReportParams], cuts: list[dt.date]) -> DataFrame:
    """A row per request; lo_x and hi_x are the first and last segment of window x (segment k
    starts at cut point k, from 1; an empty window has lo 1 and hi 0)."""
    rows = []
    for i, p in requests.items():
        if p.impact_mode is not ImpactMode.SELECTED:
            raise ValueError("requests in one pass pick a base impact")
        spans = []
        for a, b, counted in _windows(p).values():
            spans += [bisect_right(cuts, a), bisect_right(cuts, b + DAY) - 1] if counted and a <= b else [1, 0]
        rows.append((i, p.program_id, p.base_impact_id, p.multiplier_set_id, p.multiplier_set_id_to_date, p.multiplier_per_year,
                     p.report_currency_id, p.numeric_factor, p.default_milestone_date, p.filter_date_start, p.filter_date_end,
                     p.today + dt.timedelta(days=p.due_in_next_n_days), *spans))
    kind = "string" if any(isinstance(p.program_id, str) for p in requests.values()) else "bigint"
    money = "string" if any(isinstance(p.report_currency_id, str) for p in requests.values()) else "bigint"
    spans = ", ".join(f"lo_{x} int, hi_{x} int" for x in ("ot_w", "re_w", "ot_t", "re_t"))
    return spark.createDataFrame(rows, f"request_id int, program_id {kind}, base_impact_id string, set_w int, set_t int, per_year int, "
                                 f"report_currency_id {money}, own_factor decimal(19,4), default_date date, filter_start date, "
                                 f"filter_end date, due_until date, {spans}")


def series(impact: DataFrame, multiplier_set_day: DataFrame, n_currencies: int, requests: dict[int, ReportParams],
           cuts: list[dt.date], wanted: DataFrame) -> DataFrame:
    """(program_id, roadmap_id, base_impact_id, sums): a map from 'set|kind|default date' to the first
    segment and the running sums from it on. `wanted`: the requests' programs and base impacts."""
    spark = impact.sparkSession
    sets = sorted({s for p in requests.values() for s in (p.multiplier_set_id, p.multiplier_set_id_to_date)})
    defaults = F.array(*[F.lit(d) for d in sorted({p.default_milestone_date for p in requests.values()})])
    first, end = cuts[0], cuts[-1]
    calendar = spark.createDataFrame([(first, end - DAY)], "a date, b date").select(F.explode(F.sequence("a", "b")).alias("d"))
    segment = calendar.withColumn("segment", F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col("d"))))
    kept = impact.join(F.broadcast(wanted.select("program_id", "base_impact_id").distinct()), ["program_id", "base_impact_id"], "left_semi")
    totals = full_totals(kept)
    # a row without a date stands once for each default date
    dated = totals.withColumn("x", F.explode(F.when(F.col("d").isNull(), F.transform(
        defaults, lambda c: F.struct(c.alias("day"), c.cast("string").alias("tag")))).otherwise(
        F.array(F.struct(F.col("d").alias("day"), F.lit("").alias("tag"))))))
    days = (end - first).days
    dated = dated.select("program_id", "roadmap_id", "base_impact_id", "program_currency_id", "financial", "kind", "intercept", "slope",
                         F.col("x.day").alias("d"), F.col("x.tag").alias("tag"), F.explode(F.array(*[F.lit(s) for s in sets])).alias("set"))
    dated = dated.join(broadcast_if_bounded(segment, days, RATE_BYTES), "d")
    rates = multiplier_set_day.where((F.col("day") >= F.lit(first)) & (F.col("day") < F.lit(end)) & F.col("multiplier_set").isin(sets)).select(
        F.col("day").alias("d"), "program_currency_id", F.col("multiplier_set").alias("set"), "exchange_rate", "financial_multiplier",
        "multiplier")
    rated = dated.join(broadcast_if_bounded(rates, days * n_currencies * len(sets), RATE_BYTES), ["d", "program_currency_id", "set"], "left")
    fin = F.col("financial") == True  # noqa: E712  (NULL -> not financial)
    one_time = F.col("intercept").cast("decimal(19,4)") * F.when(fin, F.col("exchange_rate")).otherwise(F.lit(1))
    recurring = F.col("slope").cast("decimal(19,4)") * F.when(fin, F.col("financial_multiplier")).otherwise(F.col("multiplier"))
    owner = ["program_id", "roadmap_id", "base_impact_id"]
    one = [*owner, "set", "kind", "tag"]
    zero = F.lit(0).cast(SUM_TYPE)
    sums = rated.groupBy(*one, "segment").agg(
        F.coalesce(F.sum(one_time.cast(SUM_TYPE)), zero).alias("ot"), F.coalesce(F.sum(recurring.cast(SUM_TYPE)), zero).alias("re"))
    # a window per series: at most one row per segment, and the rows of one roadmap's series stay together
    w = Window.partitionBy(*one).orderBy("segment")
    running = sums.select(*one, "segment", F.sum("ot").over(w).cast(SUM_TYPE).alias("ot"), F.sum("re").over(w).cast(SUM_TYPE).alias("re"),
                          F.coalesce(F.lead("segment").over(w), F.lit(len(cuts))).alias("until"))
    lists = running.groupBy(*one).agg(F.array_sort(F.collect_list(F.struct("segment", "ot", "re", "until"))).alias("x"))
    dense = F.flatten(F.transform("x", lambda x: F.array_repeat(F.struct(x["ot"].alias("ot"), x["re"].alias("re")), x["until"] - x["segment"])))
    entry = F.struct(F.concat_ws("|", "set", "kind", "tag").alias("key"),
                     F.struct(F.element_at("x", 1)["segment"].alias("first"), dense.alias("sums")).alias("value"))
    return lists.select(*owner, entry.alias("entry")).groupBy(*owner).agg(F.map_from_entries(F.collect_list("entry")).alias("sums"))


def _window_sums() -> Column:
    """One-time and recurring sum of each metric over a request's windows, in order: of the dated
    series plus the one for its default date. One lambda for all twelve keeps the generated code small."""
    zero = F.lit(0).cast(SUM_TYPE)
    asked = [F.struct(F.concat_ws("|", F.col(f"set_{s}").cast("string"), F.lit(kind)).alias("key"), F.lit(half == "ot").alias("one_time"),
                      F.col(f"lo_{half}_{s}").alias("lo"), F.col(f"hi_{half}_{s}").alias("hi"))
             for kind, to_date in METRICS.values() for s in ("t" if to_date else "w",) for half in ("ot", "re")]

    def window(x: Column) -> Column:
        def up_to(of: Column, k: Column) -> Column:
            at = F.get(of["sums"], k - of["first"])
            return F.coalesce(F.when(k >= of["first"], F.when(x["one_time"], at["ot"]).otherwise(at["re"])), zero)

        def between(tag: Column) -> Column:
            of = F.element_at("sums", F.concat_ws("|", x["key"], tag))
            return up_to(of, x["hi"]) - up_to(of, x["lo"] - 1)

        total = between(F.lit("")) + between(F.col("default_date").cast("string"))
        return F.when(x["hi"] >= x["lo"], total).otherwise(zero).cast(SUM_TYPE)

    return F.transform(F.array(*asked), window)


def value_requests(tables, requests: dict[int, ReportParams]) -> DataFrame:
    """request_id, the milestone keys due under each request, numeric_factor and the six metrics."""
    t, spark = tables, tables.impact.sparkSession
    cuts = cut_points(requests) or [dt.date(1970, 1, 1), dt.date(1970, 1, 2)]
    asked = request_rows(spark, requests, cuts)
    if not fits_broadcast(len(requests), REQUEST_BYTES):
        raise ValueError("too many requests for one pass")
    factor = t.base_impact_factor.select("base_impact_id", F.col("program_currency_id").alias("report_currency_id"), "numeric_factor")
    asked = F.broadcast(asked.join(factor, ["base_impact_id", "report_currency_id"], "left"))
    # milestones due under each request, of roadmaps with an impact of its base impact
    bases = F.broadcast(asked.select("base_impact_id").distinct())
    with_impact = t.impact.join(bases, "base_impact_id", "left_semi").select("roadmap_id", "base_impact_id").distinct()
    roadmaps = t.filtered_roadmap.select("roadmap_id", "program_id", "project_id").join(asked, "program_id").join(
        with_impact, ["roadmap_id", "base_impact_id"], "left_semi")
    valued = roadmaps.join(series(t.impact, t.multiplier_set_day, t.program_currency.count(), requests, cuts, asked),
                           ["program_id", "roadmap_id", "base_impact_id"], "left")
    own = F.coalesce("own_factor", "numeric_factor")
    per_year = F.col("per_year").cast("decimal(4,0)")
    metrics = []
    for i, metric in enumerate(METRICS):
        ot = F.get("halves", F.lit(2 * i)).cast("decimal(30,10)") * per_year
        re = F.get("halves", F.lit(2 * i + 1)).cast("decimal(34,10)")
        metrics.append(((ot + re).cast(SUM_TYPE) / (per_year * own)).cast(METRIC_TYPE).alias(metric))
    valued = valued.withColumn("halves", _window_sums()).select(
        "request_id", "program_id", "project_id", "roadmap_id", "base_impact_id", "filter_start", "filter_end", "due_until",
        "numeric_factor", *metrics)
    due = t.milestone.where((F.col("tl_overall") != 1)).select("roadmap_id", "milestone_id", "plan_date", "forecast_date")
    inside = (F.col("plan_date").between(F.col("filter_start"), F.col("filter_end"))) & (F.col("forecast_date") <= F.col("due_until"))
    return valued.join(due, "roadmap_id").where(inside).select(
        "request_id", "program_id", "project_id", "roadmap_id", "milestone_id", "base_impact_id", "numeric_factor", *METRICS).distinct()
