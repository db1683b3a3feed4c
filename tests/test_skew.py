"""A key holding a third of the rows: results stay whole and exact."""

import datetime as dt
from decimal import Decimal

import pytest

from helpers import make_tables
from tollgate.operators.asof import status_as_of
from tollgate.operators.attributes import attribute_pivot
from tollgate.operators.valuation import value_keys
from tollgate.params import ImpactMode, ReportParams


def test_status_hot_roadmap(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(1, i % 5 + 1, base + dt.timedelta(minutes=i)) for i in range(6000)]          # hot roadmap
    rows += [(r, r % 5 + 1, base + dt.timedelta(hours=r)) for r in range(2, 12002)]        # 12000 others
    audit = spark.createDataFrame(rows, "roadmap_id bigint, traffic_light int, audit_time timestamp_ntz")
    got = {r.roadmap_id: r.traffic_light for r in status_as_of(audit, None, dt.date(2024, 3, 1), 14).collect()}
    assert got[1] == (5999 % 5 + 1)
    cutoff = dt.datetime(2024, 2, 17)
    expected_others = {r: r % 5 + 1 for r in range(2, 12002) if base + dt.timedelta(hours=r) < cutoff}
    assert {k: v for k, v in got.items() if k != 1} == expected_others


def test_attribute_pivot_hot_milestone(spark):
    rows = [(1, 2, f"v{i % 3}") for i in range(9000)] + [(m, 1, f"o{m}") for m in range(2, 18002)]
    eav = spark.createDataFrame(rows, "milestone_id bigint, attribute_id int, text_value string")
    got = {r.milestone_id: r for r in attribute_pivot(eav).collect()}
    assert len(got) == 18001
    assert got[1].Project_Status_Rationale == "v0 | v1 | v2"
    assert got[17].Milestone_Owner == "o17"


def test_valuation_hot_roadmap(spark):
    d = dt.date(1999, 6, 1)
    dec = Decimal
    imp = [(1, 10, "B1", 1, 0, False, d, d, d, dec("1.25"), dec("0"), dec("0"), dec("0"), dec("0"), dec("0"))
           for _ in range(6000)]
    imp += [(r, r * 10, "B1", 1, 0, False, d, d, d, dec("2"), dec("0"), dec("0"), dec("0"), dec("0"), dec("0"))
            for r in range(2, 12002)]
    msd = [(d, 0, s, dec("1"), dec("1"), dec("1")) for s in (1, 2)]
    t = make_tables(spark, impact=imp, multiplier_set_day=msd, program_currency=[(0, 0), (1, 1)],
                    base_impact_factor=[("B1", 1, dec("1"))])
    keys = spark.createDataFrame([(1, 1, r, r * 10, "B1") for r in range(1, 12002)],
                                 "program_id int, project_id bigint, roadmap_id bigint, milestone_id bigint, "
                                 "base_impact_id string")
    p = ReportParams(program_id=1, base_impact_id="B1", report_currency_id=1, one_time_start=dt.date(1999, 1, 1),
                     one_time_end=dt.date(1999, 12, 31), recurring_start=dt.date(1999, 1, 1),
                     recurring_end=dt.date(1999, 12, 31), calculation_date_as_of=dt.date(1999, 12, 31))
    got = {r.roadmap_id: r.Plan for r in value_keys(keys, t, p).collect()}
    assert got[1] == Decimal("7500")
    assert all(v == 2 for k, v in got.items() if k != 1)


def test_report_compares_no_wide_rows(spark):
    """The DISTINCT is taken on the parts: nothing is aggregated after the last joins."""
    from tollgate.plans.queries import P, _t
    from tollgate.plans.report import report_rows

    df = report_rows(_t(spark, "/root/testdata/sf0.001"), P)
    plan = df._jdf.queryExecution().executedPlan().toString().split("Join")[0]
    assert "HashAggregate" not in plan and "Exchange" not in plan
    assert df.count() == df.distinct().count() > 0


@pytest.mark.parametrize("mode", [ImpactMode.SELECTED, ImpactMode.NONE, ImpactMode.UNSET])
def test_hot_roadmap_join_is_split_by_aqe(spark, mode, tmp_path):
    """Half of the milestones on one roadmap: the driving join is split in every mode."""
    import os
    import sys

    from pyspark.sql import functions as F

    from tollgate.params import DEFAULT_PARAMS
    from tollgate.plans.queries import _t
    from tollgate.plans.report import milestone_base

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from plan_summary import final_only

    p = DEFAULT_PARAMS.with_(impact_mode=mode, base_impact_id="N3" if mode is ImpactMode.SELECTED else None)
    t = _t(spark, "/root/testdata/sf0.01")
    hot_id = milestone_base(t, p).select("roadmap_id").first()[0]
    ms = t.milestone.withColumn("roadmap_id", F.when(F.col("milestone_id") % 2 == 0, F.lit(hot_id)).otherwise(F.col("roadmap_id")))
    ms.repartition(6).write.parquet(str(tmp_path / "milestone"))
    hot = t.replace(milestone=spark.read.parquet(str(tmp_path / "milestone")))
    expected = sorted(map(repr, milestone_base(hot, p).collect()))
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        df = milestone_base(hot, p)
        qe = df._jdf.queryExecution()
        got = sorted(map(repr, df.collect()))
        qe.toRdd().count()
        plan = final_only(qe.executedPlan().toString())
    finally:
        for k in confs:
            spark.conf.unset(k)
    assert got == expected and got
    assert "skew=true" in plan


def test_hot_project_join_is_split_by_aqe(spark):
    """A project holding half the report rows: AQE splits that join (the headers are
    read from a shuffle), and the rows are the same as without the split."""
    import sys
    import os

    from pyspark.sql import functions as F

    from tollgate.params import DEFAULT_PARAMS
    from tollgate.plans.queries import _t
    from tollgate.plans.report import report_rows

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from plan_summary import final_only

    t = _t(spark, "/root/testdata/sf0.01")
    hot = t.replace(filtered_roadmap=t.filtered_roadmap.withColumn(
        "project_id", F.when(F.col("roadmap_id") % 2 == 0, F.lit(1)).otherwise(F.col("project_id"))))
    expected = sorted(map(tuple, report_rows(hot, DEFAULT_PARAMS).collect()))
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        df = report_rows(hot, DEFAULT_PARAMS)
        qe = df._jdf.queryExecution()
        got = sorted(map(tuple, df.collect()))
        qe.toRdd().count()
        plan = final_only(qe.executedPlan().toString())
    finally:
        for k in confs:
            spark.conf.unset(k)
    assert got == expected and got
    assert "skew=true" in plan
