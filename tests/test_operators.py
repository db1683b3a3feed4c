import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import make_tables
from tollgate.operators import cache as C
from tollgate.operators.asof import status_as_of
from tollgate.operators.attributes import attribute_pivot
from tollgate.operators.filters import apply_impact_mode, due_window
from tollgate.operators.hierarchy import tree_attributes, tree_path
from tollgate.operators.valuation import value_keys
from tollgate.params import ImpactMode, ReportParams

D = dt.date
P = ReportParams(today=D(2000, 1, 1), due_in_next_n_days=30, filter_date_start=D(1999, 1, 1),
                 filter_date_end=D(2000, 12, 31))


def ms_row(mid, forecast, tl=4, plan=D(1999, 6, 1), rid=1):
    return (rid, mid, 1, f"m{mid}", plan, forecast, forecast, 1, tl)


def test_due_window_bounds(spark):
    t = make_tables(spark, milestone=[
        ms_row(1, D(2000, 1, 31)),          # today + N: kept
        ms_row(2, D(2000, 2, 1)),           # today + N + 1: dropped
        ms_row(3, None),                    # no forecast: dropped
        ms_row(4, D(1990, 1, 1)),           # long overdue: kept
        ms_row(5, D(2000, 1, 1), tl=1),     # status 1: dropped
        ms_row(6, D(2000, 1, 1), tl=None),  # no status: dropped
        ms_row(7, D(2000, 1, 1), plan=None),
        ms_row(8, D(2000, 1, 1), plan=D(1998, 12, 31)),
    ])
    got = sorted(r.milestone_id for r in due_window(t.milestone, P).collect())
    assert got == [1, 4]


def impact_row(rid, bi, d=D(1999, 6, 1), fin=False, cur=0, ic="10", sl="12", program=1):
    dec = Decimal
    return (rid, rid * 10, bi, program, cur, fin, d, d, d, dec(ic), dec(sl), dec(ic), dec(sl), dec(ic), dec(sl))


def test_impact_modes(spark):
    t = make_tables(spark, impact=[impact_row(1, "B1"), impact_row(2, "B2")])
    rows = spark.createDataFrame([(1,), (2,), (3,)], "roadmap_id bigint")
    sel = apply_impact_mode(rows, t.impact, P.with_(impact_mode=ImpactMode.SELECTED, base_impact_id="B1"))
    assert [(r.roadmap_id, r.base_impact_id) for r in sel.collect()] == [(1, "B1")]
    unset = apply_impact_mode(rows, t.impact, P.with_(impact_mode=ImpactMode.UNSET, base_impact_id=None))
    assert sorted(r.roadmap_id for r in unset.collect()) == [1, 2, 3]
    none = apply_impact_mode(rows, t.impact, P.with_(impact_mode=ImpactMode.NONE, base_impact_id=None))
    assert [(r.roadmap_id, r.base_impact_id) for r in none.collect()] == [(3, None)]


def test_status_rank_ties_and_age_boundary(spark):
    as_of = D(2024, 1, 20)
    audit = spark.createDataFrame([
        (1, 3, dt.datetime(2024, 1, 6, 23, 59)),   # 14 calendar days old: in
        (1, 4, dt.datetime(2024, 1, 6, 23, 59)),   # same time: a tie, kept too
        (1, 5, dt.datetime(2024, 1, 7, 0, 0)),     # 13 days old: out
        (2, 2, dt.datetime(2024, 1, 1, 0, 0)),
    ], "roadmap_id bigint, traffic_light int, audit_time timestamp_ntz")
    got = sorted((r.roadmap_id, r.traffic_light) for r in status_as_of(audit, None, as_of, 14).collect())
    assert got == [(1, 3), (1, 4), (2, 2)]


def test_attribute_pivot_single_and_multi_values(spark):
    eav = spark.createDataFrame([(1, 1, "a"), (1, 2, "x"), (1, 2, "w"), (1, 2, "x"), (2, 7, "z")],
                                "milestone_id bigint, attribute_id int, text_value string")
    got = {r.milestone_id: r for r in attribute_pivot(eav).collect()}
    assert got[1].Milestone_Owner == "a"
    assert got[1].Project_Status_Rationale == "w | x"
    assert got[1].Project_Decisions_Needed is None
    assert got[2].Roadmap_Interdependency == "z"


def multipliers(spark, day, cur=0, rows=((1, "1.50", "2", "12"), (2, "2.00", "3", "12"))):
    return [(day, cur, s, Decimal(ex), Decimal(fm), Decimal(m)) for s, ex, fm, m in rows]


def value(spark, impacts, msd, p, factor=(("B1", 1, "2"),)):
    t = make_tables(
        spark, impact=impacts, multiplier_set_day=msd, program_currency=[(0, 0), (1, 1)],
        base_impact_factor=[(b, c, Decimal(f)) for b, c, f in factor],
    )
    keys = spark.createDataFrame([(1, 10, 1, 100, p.base_impact_id)],
                                 "program_id int, project_id bigint, roadmap_id bigint, milestone_id bigint, "
                                 "base_impact_id string")
    return value_keys(keys, t, p).collect()


PV = ReportParams(program_id=1, base_impact_id="B1", report_currency_id=1, one_time_start=D(1999, 1, 1),
                  one_time_end=D(1999, 12, 31), recurring_start=D(1999, 1, 1), recurring_end=D(1999, 12, 31),
                  calculation_date_as_of=D(1999, 12, 31), default_milestone_date=D(1999, 6, 1),
                  multiplier_per_year=12)


def test_rollup_halves_and_rates(spark):
    d = D(1999, 6, 1)
    msd = multipliers(spark, d)
    r = value(spark, [impact_row(1, "B1", d, fin=True, ic="10", sl="12")], msd, PV)[0]
    # (10 * 1.5 + 12 * 2 / 12) / 2 ; to date uses set 2: (10 * 2 + 12 * 3 / 12) / 2
    assert r.Plan == pytest.approx((15 + 2) / 2)
    assert r.Plan_To_Date == pytest.approx((20 + 3) / 2)
    only_ot = value(spark, [impact_row(1, "B1", d, fin=True)], msd, PV.with_(include_recurring=False))[0]
    assert only_ot.Plan == pytest.approx(15 / 2)
    neither = value(spark, [impact_row(1, "B1", d, fin=True)], msd,
                    PV.with_(include_recurring=False, include_one_time=False))[0]
    assert neither.Plan == 0.0


def test_missing_rate_and_null_date(spark):
    d = D(1999, 6, 1)
    # no multiplier rows at all: financial values vanish, non-financial one-time counts with rate 1
    fin = value(spark, [impact_row(1, "B1", d, fin=True)], [], PV)[0]
    assert fin.Plan == 0.0
    nonfin = value(spark, [impact_row(1, "B1", d, fin=False, ic="10")], [], PV)[0]
    assert nonfin.Plan == pytest.approx(10 / 2)
    # NULL date falls back to the default date, which drives window and rate
    nulld = value(spark, [impact_row(1, "B1", None, fin=True)], multipliers(spark, d), PV)[0]
    assert nulld.Plan == pytest.approx((15 + 2) / 2)


def test_factor_parameter_and_missing_factor(spark):
    d = D(1999, 6, 1)
    msd = multipliers(spark, d)
    r = value(spark, [impact_row(1, "B1", d, fin=True)], msd, PV.with_(numeric_factor=Decimal("4")))[0]
    assert r.Plan == pytest.approx(17 / 4)
    nf = value(spark, [impact_row(1, "B1", d, fin=True)], msd, PV, factor=())[0]
    assert nf.Plan is None
    unset = value(spark, [impact_row(1, "B1", d)], msd,
                  PV.with_(impact_mode=ImpactMode.UNSET, base_impact_id=None))[0]
    assert unset.Plan is None and unset.numeric_factor is None


def test_tree_path_and_program_filter(spark):
    bi = [
        ("R", None, 1, "root", "u", Decimal("1.7"), True, False, 2),
        ("C", "R", 1, "child", "u", Decimal("1234"), None, True, 1),
        ("G", "C", 2, "grandchild", "u", Decimal("7"), False, False, 2),  # other program
        ("X", None, 2, "other root", "u", Decimal("1"), True, True, 1),
    ]
    t = make_tables(spark, base_impact=bi)
    got = {r.base_impact_id: (r.sort_path, r.depth) for r in tree_path(spark, t.base_impact, 1).collect()}
    assert got == {"R": ("::001", 1), "C": ("::001::234", 2), "G": ("::001::234::007", 3)}
    attrs = {r.BaseImpactID: r for r in tree_attributes(spark, t.base_impact, 1).collect()}
    assert set(attrs) == {"R", "C"}
    assert attrs["C"].IsFinancial is False and attrs["R"].IsRecurring is True


def test_tree_is_not_capped_in_a_plain_session(spark):
    """A session without the recommended settings, with a small row limit for recursive queries."""
    plain = spark.newSession()
    plain.conf.set("spark.sql.cteRecursionRowLimit", "10")
    rows = [("R", None, 1)] + [(f"C{i}", "R", 1) for i in range(30)] + [(f"G{i}", f"C{i % 30}", 1) for i in range(60)]
    bi = plain.createDataFrame([(*r, i) for i, r in enumerate(rows)],
                               "base_impact_id string, parent_id string, program_id int, sort_order int")
    got = {r.base_impact_id: (r.parent_id, r.sort_path, r.depth) for r in tree_path(plain, bi, 1).collect()}
    path = {"R": "::000"}
    for i, (k, parent, _) in enumerate(rows[1:], 1):
        path[k] = f"{path[parent]}::{i:03d}"
    assert got == {k: (parent, path[k], path[k].count("::")) for k, parent, _ in rows}
    assert tree_path(plain, bi, 2).count() == 0
    # a cycle below a root ends in an error at the level limit, not in an endless loop
    plain.conf.set("spark.sql.cteRecursionLevelLimit", "5")
    cycle = plain.createDataFrame([("R", None, 1, 0), ("A", "R", 1, 1), ("B", "A", 1, 2), ("A", "B", 1, 3)], bi.schema)
    with pytest.raises(Exception, match="levels"):
        tree_path(plain, cycle, 1).count()


def cache_row(spark, pid, mid, bi):
    vals = {c: None for c in C.CACHE_COLUMNS}
    vals.update(A_FK_REPORT_CACHE=11, A_FK_REPORT_FILTER_CACHE=7, A_FK_SNAPSHOT=1,
                A_LAST_MODIFIED_FOR_CACHE_UTC=dt.datetime(2024, 1, 1), A_ROADMAP_SUBSET_HASH=5,
                P_ID=pid, A_FK_Milestone=mid, A_FK_BASE_IMPACT=bi, PROJ_PARENT="p")
    return vals


def cache_df(spark, rows):
    ddl = ("A_FK_REPORT_CACHE int, A_FK_REPORT_FILTER_CACHE int, A_FK_SNAPSHOT int, "
           "A_LAST_MODIFIED_FOR_CACHE_UTC timestamp_ntz, A_ROADMAP_SUBSET_HASH bigint, P_ID bigint, "
           "A_FK_Milestone bigint, A_FK_BASE_IMPACT string, PROJ_PARENT string")
    df = spark.createDataFrame([tuple(r[c] for c in ddl_cols(ddl)) for r in rows], ddl)
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                       for c in C.CACHE_COLUMNS])


def ddl_cols(ddl):
    return [p.strip().split(" ")[0] for p in ddl.split(",")]


def test_merge_key_semantics(spark):
    target = cache_df(spark, [cache_row(spark, 1, 10, "B"), cache_row(spark, 1, 11, None)])
    src = cache_df(spark, [cache_row(spark, 1, 10, "B"),   # same non-null key: not inserted
                           cache_row(spark, 1, 11, None),  # NULL key never matches: inserted again
                           cache_row(spark, 2, 20, "B"), cache_row(spark, 2, 20, "B")])  # dup source rows
    ins = C.rows_to_insert(src, target).collect()
    assert sorted((r.P_ID, r.A_FK_Milestone) for r in ins) == [(1, 11), (2, 20), (2, 20)]
    assert C.merged(src, target).count() == 5


def test_impact_choice():
    from tollgate.params import impact_choice

    assert impact_choice([]) == (ImpactMode.UNSET, None)
    assert impact_choice(["00000000-0000-0000-0000-000000000000"]) == (ImpactMode.NONE, None)
    assert impact_choice(["N3"]) == (ImpactMode.SELECTED, "N3")
    with pytest.raises(ValueError):
        impact_choice(["a", "b"])


def test_status_label_folds_ties(spark):
    from tollgate.operators.asof import status_label

    s = spark.createDataFrame([(1, 3), (1, 4), (1, 3), (2, None)], "roadmap_id bigint, traffic_light int")
    got = {r.roadmap_id: r.label for r in status_label(s, fold=True).collect()}
    assert got == {1: "Green; Yellow", 2: "Red"}


def test_valuation_equals_literal_six_joins(spark):
    """Metamorphic: the pre-aggregated, one-lookup valuation equals the source's
    literal form (six rate joins per impact row, group by milestone key)."""
    from literal import literal_valuation
    from tollgate.plans.queries import KEY_COLUMNS
    from tollgate.plans.queries import P as QP
    from tollgate.plans.queries import _t
    from tollgate.plans.report import filtered_milestones, valued_milestones

    t = _t(spark, "/root/testdata/sf0.001")
    ours = valued_milestones(t, QP).withColumn("numeric_factor", F.col("numeric_factor").cast("double"))
    keys = filtered_milestones(t, QP).select(*KEY_COLUMNS).distinct()
    lit = literal_valuation(t, QP, keys).select(*ours.columns)
    a, b = sorted(map(tuple, ours.collect())), sorted(map(tuple, lit.collect()))
    assert a == b and len(a) > 0


def test_pivot_equals_joins_on_unique_attributes(spark):
    from literal import literal_attribute_joins

    eav = spark.createDataFrame([(m, a, f"v{m}-{a}") for m in range(1, 200) for a in range(1, 8) if (m + a) % 3],
                                "milestone_id bigint, attribute_id int, text_value string")
    ms = spark.createDataFrame([(m,) for m in range(1, 210)], "milestone_id bigint")
    piv = ms.join(attribute_pivot(eav), "milestone_id", "left")
    lit = literal_attribute_joins(ms, eav).select(*piv.columns)
    assert sorted(map(tuple, piv.collect())) == sorted(map(tuple, lit.collect()))


def test_ordinal_is_a_total_order_position(spark):
    from tollgate.operators.ordering import with_ordinal

    rows = [(i % 7, f"k{i:05d}") for i in range(5000)]
    df = spark.createDataFrame(rows, "g int, k string")
    got = sorted((r.g, r.k, r.pos) for r in with_ordinal(df, ["g", "k"], "pos", n_partitions=6).collect())
    assert [r[2] for r in got] == list(range(1, 5001))


def test_checkpoint_folder_on_a_cluster_must_be_named():
    """No folder named: a local master gets its own, a cluster is told to name one."""
    from types import SimpleNamespace

    from tollgate.plans.materialize import checkpoint_dir

    class Context:
        folder = None

        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    def session(master, **conf):
        return SimpleNamespace(sparkContext=Context(master), conf=conf)

    assert checkpoint_dir(session("local[2]"))
    assert checkpoint_dir(session("spark://x", **{"spark.checkpoint.dir": "/shared"})) == "/shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(session("spark://x"))


def test_repeated_rate_rows_fail_loudly(spark):
    d = D(1999, 6, 1)
    msd = multipliers(spark, d) + multipliers(spark, d, rows=((1, "9.99", "9", "9"),))
    with pytest.raises(Exception, match="repeats"):
        value(spark, [impact_row(1, "B1", d, fin=True)], msd, PV)


def test_repeated_rate_rows_fail_loudly_without_one_time(spark):
    """The check hangs on the join key, so no setting prunes it away."""
    d = D(1999, 6, 1)
    msd = multipliers(spark, d) + multipliers(spark, d, rows=((1, "9.99", "9", "9"),))
    with pytest.raises(Exception, match="repeats"):
        value(spark, [impact_row(1, "B1", d, fin=True)], msd, PV.with_(include_one_time=False))


def test_large_sums_stay_exact(spark):
    """Sums beyond 10^12 keep every decimal."""
    d = D(1999, 6, 1)
    rows = [impact_row(1, "B1", d, ic="999999999999.1234", sl="0") for _ in range(7)]
    got = value(spark, rows, multipliers(spark, d), PV)
    assert got[0]["Plan"] == 7 * Decimal("999999999999.1234") / 2


def test_roles_and_ties_one_row_each_or_folded(spark):
    from tollgate.operators.asof import status_label, two_statuses
    from tollgate.operators.enrich import named_roles, role_holders
    from tollgate.operators.joins import KeyBound

    users = spark.createDataFrame([(1, "A", None), (2, "B", "x"), (3, "A", " ")], "user_id bigint, last_name string, first_name string")
    roles = spark.createDataFrame([(1, None, 5, 1), (1, None, 5, 2), (1, None, 5, 2), (2, None, 5, 9), (None, 7, 4, 1), (3, None, 4, 1)],
                                  "roadmap_id bigint, project_id bigint, role int, user_id bigint")
    named = named_roles(roles, users, {4: "project_id", 5: "roadmap_id"})
    assert sorted(map(tuple, role_holders(named, 5, "roadmap_id").collect())) == [(1, "A"), (1, "B, x"), (2, "")]
    assert sorted(map(tuple, role_holders(named, 5, "roadmap_id", fold=True).collect())) == [(1, "A; B, x"), (2, "")]
    assert [tuple(r) for r in role_holders(named, 4, "project_id").collect()] == [(7, "A")]
    at = dt.datetime
    audit = spark.createDataFrame([(1, 3, at(2024, 1, 1)), (1, 4, at(2024, 1, 1)), (1, 1, at(2024, 1, 10)), (2, 2, at(2024, 1, 11)),
                                   (3, 3, at(2024, 1, 2)), (1, 1, at(2024, 1, 19))],
                                  "roadmap_id bigint, traffic_light int, audit_time timestamp_ntz")
    ids = spark.createDataFrame([(1,), (2,), (3,)], "roadmap_id bigint")
    for bound in (KeyBound(3), KeyBound(1 << 60)):  # broadcast, and the way beyond it
        old, new = two_statuses(audit, ids, D(2024, 1, 20), 14, 7, bound)
        assert sorted(map(tuple, status_label(old).collect())) == [(1, "Green"), (1, "Yellow"), (3, "Green")]
        assert sorted(map(tuple, status_label(old, fold=True).collect())) == [(1, "Green; Yellow"), (3, "Green")]
        assert sorted(map(tuple, status_label(new).collect())) == [(1, "Black"), (2, "White"), (3, "Green")]


def test_repeated_milestone_keys_fail_loudly(spark):
    from tollgate.plans.report import driving_set

    t = make_tables(spark, milestone=[ms_row(1, D(2000, 1, 1)), ms_row(1, D(1999, 12, 1))], filtered_roadmap=[(1, 1, 1)])
    with pytest.raises(ValueError, match="repeats"):
        driving_set(t, P.with_(impact_mode=ImpactMode.UNSET, base_impact_id=None))


def test_key_bounds_count_text_bytes(spark):
    from tollgate.operators.joins import KeyBound, key_bounds

    df = spark.createDataFrame([("a" * 36, 1), ("b", 2)], "t string, n bigint")
    assert key_bounds(df, "t", "n") == {"t": KeyBound(2, 16 + 8 + 40), "n": KeyBound(2, 16)}
    assert not KeyBound(1 << 30).fits
