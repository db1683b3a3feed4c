"""Bloom reduction, status snapshots, stored impact totals and several requests in one pass."""

import datetime as dt
import glob
import os
import random
import time
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tollgate.operators import joins
from tollgate.operators.asof import status_as_of
from tollgate.operators.bloom import BLOCK_BYTES, block_count, bloom_filter, may_match
from tollgate.operators import impact_totals
from tollgate.operators.impact_totals import ImpactTotals, full_totals
from tollgate.operators.joins import KeyBound, key_bounds, semi_join_keys
from tollgate.operators.requests import value_requests
from tollgate.operators.snapshots import StatusSnapshots
from tollgate.params import DEFAULT_PARAMS as P
from tollgate.params import ImpactMode
from tollgate.plans.materialize import checkpoint_dir
from tollgate.plans.queries import impact_rollup_stored
from tollgate.plans.report import valued_milestones
from tollgate.sources.testdata import derive_tables, path_segment

SMALL = "/root/testdata/sf0.001"


def rows(df):
    return Counter(map(tuple, df.collect()))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


# ---- Bloom reduction ------------------------------------------------------------

@pytest.mark.parametrize("text", [False, True])
def test_bloom_filter_keeps_every_key_and_few_others(spark, text):
    def named(c):
        return F.concat(F.lit("key-"), F.col(c).cast("string")).alias("k") if text else F.col(c).alias("k")

    keys = spark.range(0, 40_000, 2).select(named("id"))
    other = spark.range(1, 400_001, 2).select(named("id"))
    blocks = block_count(20_000, 20_000 * 3)
    assert 0 < blocks * BLOCK_BYTES <= 60_000
    filter_ = bloom_filter(keys, "k", blocks)
    assert filter_.count() <= blocks
    assert may_match(keys, "k", filter_, blocks).count() == 20_000
    assert may_match(other, "k", filter_, blocks).count() < 0.04 * 200_000


def test_too_small_a_budget_gives_no_filter():
    assert block_count(1_000_000, 100_000) == 0 and block_count(1, 0) == 0
    assert block_count(1000, 1 << 30) == 32  # sixteen bits a key are enough


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_semi_join_beyond_the_budget_filters_before_its_exchange(spark, kind):
    keys = spark.range(500).select(F.col("id").cast(kind).alias("k")).union(spark.range(500).select(F.col("id").cast(kind)))
    wide = spark.range(50_000).select((F.col("id") % 20_000).cast(kind).alias("k"), F.col("id").alias("v")).union(
        spark.createDataFrame([(None, 1)], f"k {kind}, v bigint"))
    bound = key_bounds(keys, "k")["k"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        ways = {n: semi_join_keys(wide, keys, "k", bound, budget) for n, budget in
                (("broadcast", 1 << 20), ("bloom", bound.rows * bound.row_bytes // 2), ("shuffled", 10))}
        plans = {n: final_plan(df) for n, df in ways.items()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert rows(ways["bloom"]) == rows(ways["broadcast"]) == rows(ways["shuffled"])
    assert sum(rows(ways["bloom"]).values()) == 1500
    final = plans["bloom"].split("== Initial Plan ==")[0]
    assert "bit_or" in final and "SortMergeJoin" in final
    # the probe stands below the exchange of the exact join's large side
    large = final[final.index("SortMergeJoin"):]
    assert large.index("Exchange hashpartitioning(k") < large.index("BroadcastHashJoin")
    assert "bit_or" not in plans["broadcast"] and "bit_or" not in plans["shuffled"]


def test_report_keys_beyond_the_budget(spark, monkeypatch):
    """The whole valuation with every key set beyond the broadcast budget."""
    t = derive_tables(spark, SMALL)
    want = rows(valued_milestones(t, P))
    monkeypatch.setattr(joins, "BROADCAST_MAX_BYTES", 600)
    assert rows(valued_milestones(t, P)) == want and want


# ---- snapshots of a growing history ------------------------------------------------

AS_OF = dt.date(2024, 3, 20)


def audit_rows(spark, seed, n=400):
    r = random.Random(seed)
    data = [(r.randrange(30) if r.random() < 0.6 else 7, r.choice([None, 1, 2, 3]),
             None if r.random() < 0.02 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=6 * r.randrange(320))) for _ in range(n)]
    return spark.createDataFrame(data, "roadmap_id bigint, traffic_light int, audit_time timestamp_ntz")


def test_status_from_snapshots_equals_the_full_scan(spark, tmp_path):
    parts = [audit_rows(spark, i) for i in range(4)]
    h = StatusSnapshots(spark, str(tmp_path))
    h.add(parts[0])
    seen = parts[0]
    steps = [lambda: h.take(dt.date(2024, 1, 15)), lambda: h.add(parts[1]), lambda: h.take(dt.date(2024, 2, 20)),
             lambda: h.add(parts[2]), lambda: h.take(dt.date(2024, 1, 15)), lambda: h.add(parts[2], batch=2),
             lambda: h.take(dt.date(2024, 3, 1)), lambda: h.add(parts[3])]
    for k, step in enumerate(steps):
        step()
        seen = parts[0] if k < 1 else parts[0].union(parts[1]) if k < 3 else parts[0].union(parts[1]).union(parts[2])
        if k == 7:
            seen = seen.union(parts[3])
        for age in (0, 7, 30, 100):
            want = status_as_of(seen, None, AS_OF, age)
            assert rows(h.status_as_of(AS_OF, age)) == rows(want), (k, age)
    some = spark.createDataFrame([(7,), (8,), (999,)], "roadmap_id bigint")
    assert rows(h.status_as_of(AS_OF, 7, some)) == rows(status_as_of(seen, some, AS_OF, 7))
    assert h.batches() == 4 and h.taken()[dt.date(2024, 3, 1)] == 3


def test_snapshot_request_reads_one_snapshot_and_the_rows_since(spark, tmp_path):
    h = StatusSnapshots(spark, str(tmp_path))
    h.add(audit_rows(spark, 1, 3000))
    for day in (dt.date(2024, 2, 1), dt.date(2024, 3, 1)):
        h.take(day)
    df = h.rows_before(dt.datetime(2024, 3, 14))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan and "GreaterThanOrEqual(audit_time,2024-03-01" in plan
    assert "2024-02-01" not in plan
    with pytest.raises(ValueError):
        StatusSnapshots(spark, str(tmp_path / "none")).rows_before(dt.datetime(2024, 1, 1))


# ---- stored impact totals -----------------------------------------------------------

IMPACT = ("roadmap_id bigint, milestone_id bigint, base_impact_id string, program_id bigint, program_currency_id int, financial boolean, "
          "plan_date date, actual_date date, forecast_date date, plan_intercept decimal(19,4), plan_slope decimal(19,4), "
          "actual_intercept decimal(19,4), actual_slope decimal(19,4), forecast_intercept decimal(19,4), forecast_slope decimal(19,4)")


def impact_row(r):
    def day():
        return None if r.random() < 0.2 else dt.date(1998, 1, 1) + dt.timedelta(days=r.randrange(5))

    money = [None if r.random() < 0.1 else Decimal(r.randrange(-10**9, 10**9)) / 10000 for _ in range(6)]
    return (r.randrange(4), 1, r.choice(["N1", "N2", None]), 1, r.randrange(2), r.choice([True, False, None]), day(), day(), day(), *money)


def test_totals_after_any_changes_equal_a_recompute(spark, tmp_path):
    r = random.Random(11)
    current = [impact_row(r) for _ in range(200)]
    view = ImpactTotals(spark, str(tmp_path))
    view.load(spark.createDataFrame(current, IMPACT))
    for batch in range(1, 6):
        gone = [current.pop(r.randrange(len(current))) for _ in range(40)]
        new = [impact_row(r) for _ in range(30)]
        updated = [current.pop(r.randrange(len(current))) for _ in range(10)]
        better = [(*x[:9], Decimal("1.5"), *x[10:]) for x in updated]
        current += new + better
        changes = spark.createDataFrame([(*x, s) for xs, s in ((gone, -1), (updated, -1), (new, 1), (better, 1)) for x in xs], IMPACT + ", sign int")
        view.apply(changes, batch)
        if batch == 2:
            view.apply(changes, batch)  # a repeated job counts once
        if batch == 3:
            view = view.compact()
        assert rows(view.read()) == rows(full_totals(spark.createDataFrame(current, IMPACT))), batch
    view.apply(spark.createDataFrame([(*x, -1) for x in current], IMPACT + ", sign int"), 9)
    assert view.read().isEmpty()


def test_a_deleted_row_that_was_not_stored_is_an_error(spark, tmp_path):
    r = random.Random(1)
    view = ImpactTotals(spark, str(tmp_path))
    view.load(spark.createDataFrame([], IMPACT))
    assert view.read().isEmpty()
    view.apply(spark.createDataFrame([(*impact_row(r), -1)], IMPACT + ", sign int"), 1)
    with pytest.raises(Exception, match="not stored"):
        view.read().collect()


# ---- several requests in one pass -----------------------------------------------------

def test_requests_in_one_pass_equal_one_report_each(spark):
    t = derive_tables(spark, SMALL)
    r = random.Random(5)

    def day():
        return dt.date(1993, 1, 1) + dt.timedelta(days=r.randrange(3000))

    requests = {i: P.with_(
        program_id=r.randrange(3), base_impact_id=f"N{r.randrange(6)}", one_time_start=day(), one_time_end=day(), recurring_start=day(),
        recurring_end=day(), calculation_date_as_of=day(), default_milestone_date=day(), include_one_time=r.random() < 0.8,
        include_recurring=r.random() < 0.8, multiplier_set_id=r.choice([1, 2]), multiplier_set_id_to_date=r.choice([1, 2]),
        multiplier_per_year=r.choice([1, 4, 12]), report_currency_id=r.randrange(3), filter_date_start=dt.date(1992, 1, 1),
        today=day(), due_in_next_n_days=r.randrange(900), numeric_factor=r.choice([None, Decimal("2.5")])) for i in range(7)}
    got = value_requests(t, requests).drop("numeric_factor").collect()
    n = 0
    for i, p in requests.items():
        want = valued_milestones(t, p).drop("numeric_factor").collect()
        columns = want[0].__fields__ if want else []
        assert Counter(tuple(x[c] for c in columns) for x in got if x.request_id == i) == Counter(map(tuple, want)), i
        n += len(want)
    assert n == len(got) > 20


def test_requests_without_windows_or_base_impact(spark):
    t = derive_tables(spark, SMALL)
    off = P.with_(include_one_time=False, include_recurring=False)
    got = value_requests(t, {1: off})
    assert rows(got.drop("request_id", "numeric_factor").select("milestone_id", "Plan", "Actual_To_Date")) == rows(
        valued_milestones(t, off).select("milestone_id", "Plan", "Actual_To_Date"))
    with pytest.raises(ValueError):
        value_requests(t, {1: P.with_(impact_mode=ImpactMode.UNSET, base_impact_id=None)})


# ---- whole relations --------------------------------------------------------------------

def test_tree_paths_of_large_ids_keep_their_order(spark):
    ids = [1, 9, 10, 999_999, 1_000_000, 1_234_567, 12_345_670, (1 << 63) - 1]
    got = spark.createDataFrame([(i,) for i in ids], "id bigint").withColumn("s", path_segment(F.col("id"))).orderBy("s").collect()
    assert [x.id for x in got] == ids and len({x.s for x in got}) == len(ids)


def test_no_discounted_line_is_left_out_of_the_impacts(spark):
    t = derive_tables(spark, SMALL)
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet").where("l_discount > 0").count()
    assert t.impact.count() == lines
    assert not t.filtered_roadmap.join(t.impact, "roadmap_id", "left_anti").isEmpty()


def test_key_bound_of_text_counts_its_width():
    assert not KeyBound(1_000_000, 80).fits and KeyBound(100_000, 80).fits


def test_totals_are_added_up_in_parts_of_a_bounded_size(spark, tmp_path, monkeypatch):
    """More rows make more tasks, not larger ones (AQE would coalesce them by their compressed size)."""
    r = random.Random(3)
    impact = spark.createDataFrame([impact_row(r) for _ in range(400)], IMPACT)
    want = rows(full_totals(impact))
    monkeypatch.setattr(impact_totals, "TASK_ROWS", 100)
    view = ImpactTotals(spark, str(tmp_path))
    view.load(impact)
    assert full_totals(impact).rdd.getNumPartitions() == 12 and rows(full_totals(impact)) == want
    assert view.read().rdd.getNumPartitions() > 1 and rows(view.read()) == want


def shuffles_on_disk(spark):
    names = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
    return {x.split("_")[1] for x in names.split() if x.startswith("shuffle_")}


def left_over(spark, before):
    """Shuffles that stay on disk beside those of before; they are deleted in the background."""
    until = time.time() + 20
    while (left := shuffles_on_disk(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


@pytest.mark.parametrize("pass_rows", [50, 10**6])
def test_stored_totals_leave_no_shuffle_files_and_hold_no_changes_that_cancel_out(spark, tmp_path, monkeypatch, pass_rows):
    monkeypatch.setattr(impact_totals, "TASK_ROWS", 100)
    monkeypatch.setattr(impact_totals, "PASS_ROWS", pass_rows)
    r = random.Random(17)
    data = [impact_row(r) for _ in range(200)]
    impact, again = spark.createDataFrame(data, IMPACT), spark.createDataFrame(data[:60], IMPACT)
    both = again.withColumn("sign", F.lit(1)).unionByName(again.withColumn("sign", F.lit(-1)))
    want = rows(full_totals(impact))
    before = shuffles_on_disk(spark)
    view = ImpactTotals(spark, str(tmp_path))
    view.load(impact)
    view.apply(both, 1)
    view.apply(again.withColumn("sign", F.lit(1)), 2)
    view = view.compact()
    view.apply(again.withColumn("sign", F.lit(-1)), 1)
    assert left_over(spark, before) == set()
    assert spark.read.parquet(f"{tmp_path}/gen=0/batch=1").isEmpty()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
    if pass_rows == 50:  # files of one kind each
        kinds = [spark.read.parquet(f).select("kind").distinct().count() for f in glob.glob(f"{tmp_path}/gen=*/batch=*/*.parquet")]
        assert max(kinds) == 1
    assert rows(view.read()) == want and rows(view.compact().read()) == want


def test_a_batch_is_seen_when_all_its_passes_are_done(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(impact_totals, "PASS_ROWS", 50)
    r = random.Random(19)
    impact = spark.createDataFrame([impact_row(r) for _ in range(100)], IMPACT)
    more = spark.createDataFrame([(*impact_row(r), 1) for _ in range(100)], IMPACT + ", sign int")
    view = ImpactTotals(spark, str(tmp_path))
    view.load(impact)
    want = rows(view.read())
    broken = more.withColumn("forecast_slope", F.raise_error(F.lit("no such rate")).cast("decimal(19,4)"))
    with pytest.raises(Exception, match="no such rate"):  # the last of three passes
        view.apply(broken, 1)
    assert os.path.isdir(tmp_path / "gen=0/_batch-1") and rows(view.read()) == want
    view.apply(more, 1)
    assert rows(view.read()) == rows(full_totals(impact.unionByName(more.drop("sign"))))
    new = view.compact()
    assert rows(view.read()) == rows(new.read())
    view.drop()
    assert os.listdir(tmp_path) == ["gen=1"]


def test_the_stored_rollup_keeps_the_last_generation_only(spark):
    def folders():
        return set(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/impact-*"))

    before = folders()
    impact_rollup_stored(spark, SMALL)
    [folder] = folders() - before
    assert os.listdir(folder) == ["view"] and os.listdir(f"{folder}/view") == ["gen=1"]
