"""Status as of an earlier date: the latest audit value at least N days old."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.functions.labels import traffic_light
from tollgate.operators.joins import KeyBound, key_bounds, semi_join_keys
from tollgate.plans.materialize import materialize


def age_cutoff(as_of: dt.date, min_age_days: int) -> dt.datetime:
    """Audit rows strictly before this instant are at least `min_age_days` calendar
    days old on `as_of` (day boundaries, not 24-hour periods)."""
    d = as_of - dt.timedelta(days=min_age_days - 1)
    return dt.datetime(d.year, d.month, d.day)


def status_as_of(
    audit: DataFrame,
    roadmaps: DataFrame | None,
    as_of: dt.date,
    min_age_days: int,
    time_col: str = "audit_time",
    n_roadmaps: KeyBound | None = None,
    budget: int | None = None,
) -> DataFrame:
    """(roadmap_id, traffic_light, audit_time, tl_rank) of each roadmap's latest
    audit rows at least `min_age_days` old; ties on the time are all kept.

    The age test is a comparison with a constant, so it is pushed into the scan.
    `rank() = 1` lets Spark insert a per-partition group limit before the shuffle,
    so a roadmap with a huge history sends only its top rows across the network.
    """
    rows = audit.where(F.col(time_col) < F.lit(age_cutoff(as_of, min_age_days)).cast("timestamp_ntz"))
    if roadmaps is not None:
        rows = semi_join_keys(rows, roadmaps, "roadmap_id", n_roadmaps or key_bounds(roadmaps, "roadmap_id")["roadmap_id"], budget)
    w = Window.partitionBy("roadmap_id").orderBy(F.col(time_col).desc())
    return (
        rows.select("roadmap_id", "traffic_light", F.col(time_col).alias("audit_time"))
        .withColumn("tl_rank", F.rank().over(w))
        .where(F.col("tl_rank") == 1)
    )


# With folding, tied latest rows with different lights are listed in one cell, sorted.
LABEL_SEPARATOR = "; "


def status_label(status: DataFrame, fold: bool = False) -> DataFrame:
    """(roadmap_id, label): the traffic-light labels of each roadmap's latest status.

    Rows tied on the latest time give one row per distinct label, as the source's join
    does; `fold` lists them in one cell instead. A roadmap with no row has no label
    here; the report shows 'Red' for it.
    """
    labels = status.select("roadmap_id", traffic_light(F.col("traffic_light")).alias("label")).distinct()
    if not fold:
        return labels
    return labels.groupBy("roadmap_id").agg(
        F.array_join(F.array_sort(F.collect_list("label")), LABEL_SEPARATOR).alias("label"))


def two_statuses(audit: DataFrame, roadmaps: DataFrame, as_of: dt.date, older: int, newer: int,
                 n_roadmaps: KeyBound) -> tuple[DataFrame, DataFrame]:
    """Latest rows at least `older` and at least `newer` days old (older > newer), from one
    scan of the history: the rows that tie for the latest of either cut-off are found
    in one window over the rows that pass the newer one."""
    rows = audit.where(F.col("audit_time") < F.lit(age_cutoff(as_of, newer)).cast("timestamp_ntz"))
    rows = semi_join_keys(rows, roadmaps, "roadmap_id", n_roadmaps)
    is_old = F.col("audit_time") < F.lit(age_cutoff(as_of, older)).cast("timestamp_ntz")
    # rank within the old rows and within the newer ones: a roadmap's latest row of its
    # latest overall is either old itself (then it leads both) or leads the newer side
    w = Window.partitionBy("roadmap_id", "is_old").orderBy(F.col("audit_time").desc())
    led = materialize(
        rows.select("roadmap_id", "traffic_light", "audit_time", is_old.alias("is_old"))
        .withColumn("tl_rank", F.rank().over(w)).where("tl_rank = 1"))
    old = led.where("is_old").drop("is_old")
    # the newer cut-off's latest: the newer side's leaders, or the old ones where a
    # roadmap has no newer row
    latest = Window.partitionBy("roadmap_id").orderBy(F.col("audit_time").desc())
    new = led.withColumn("tl_rank", F.rank().over(latest)).where("tl_rank = 1").drop("is_old")
    return old, new
