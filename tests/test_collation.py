"""Text keys, groups and DISTINCT under the source database's collation."""

import random
import re

from pyspark.sql import functions as F

from tollgate.functions.text import collated, distinct_rows
from tollgate.operators import cache as C
from tollgate.operators.attributes import NARRATIVE_ATTRIBUTES, attribute_fanout, attribute_pivot
from tollgate.operators.enrich import named_roles
from tollgate.operators.joins import KeyBound, semi_join_keys
from tollgate.plans.queries import P_COLLATED, _spelled
from tollgate.plans.report import report_rows
from tollgate.sources.tables import RELATIONS, TEXT_KEYS, collate_keys, relation_schema
from tollgate.sources.testdata import derive_tables

CI = "UNICODE_CI_RTRIM"


def test_only_text_keys_are_collated(spark):
    tables = derive_tables(spark, "/root/testdata/sf0.001")
    kept = collate_keys(tables, CI)
    for name in RELATIONS:
        for f in getattr(kept, name).schema.fields:
            assert ("collate" in f.dataType.simpleString()) == (f.name in TEXT_KEYS)
    assert TEXT_KEYS == ("base_impact_id", "parent_id")
    assert collate_keys(tables, None) is tables
    assert "roadmap_id STRING" in relation_schema("roadmap", text_ids=True)  # GUIDs: one spelling, binary


def test_the_first_spelling_is_kept(spark):
    rows = [("abc", 1, None), ("ABC ", 1, None), ("Abc", 1, None), ("abd", 2, "x"), ("abd", 2, "X "), (None, 3, ""), (None, 3, " ")]
    df = spark.createDataFrame(rows, "s string, n int, t string")
    for parts in (1, 7):
        got = {tuple(r) for r in distinct_rows(df.repartition(parts), CI).collect()}
        assert got == {("ABC ", 1, None), ("abd", 2, "X "), (None, 3, "")}
    assert distinct_rows(df.limit(0), CI).count() == 0
    assert distinct_rows(df.select("n"), CI).count() == 3


def test_joins_follow_the_collation(spark):
    a = collated(spark.createDataFrame([("n1", 1), ("N1  ", 2), ("n2", 3), (None, 4)], "k string, x int"), ["k", "x"], CI)
    b = collated(spark.createDataFrame([("N1", 10), ("N2 ", 20), (None, 30)], "k string, y int"), ["k"], CI)
    want = [(1, 10), (2, 10), (3, 20)]
    for hint in ("broadcast", "merge", "shuffle_hash"):
        assert sorted((r.x, r.y) for r in a.join(b.hint(hint), "k").select("x", "y").collect()) == want
    assert [r.x for r in a.where(F.col("k") == "N2").collect()] == [3]


def test_no_hash_filter_of_collated_keys(spark):
    """A Bloom filter of hashes would drop 'n1' for 'N1'; beyond the broadcast budget the join is left alone."""
    df = collated(spark.range(2000).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("k")), ["k"], CI)
    keys = collated(spark.range(0, 2000, 2).select(F.concat(F.lit("N"), F.col("id").cast("string"), F.lit(" ")).alias("k")), ["k"], CI)
    assert semi_join_keys(df, keys, "k", KeyBound(1000, 24), budget=4096).count() == 1000


def test_groups_follow_the_collation(spark):
    eav = spark.createDataFrame([(1, 1, "late"), (1, 1, "LATE "), (1, 1, "new"), (1, 2, "x"), (2, 1, "late"), (2, 1, None)],
                                "milestone_id bigint, attribute_id int, text_value string")
    got = {r.milestone_id: r for r in attribute_pivot(eav, text_collation=CI).collect()}
    assert (got[1].Milestone_Owner, got[1].Project_Status_Rationale, got[2].Milestone_Owner) == ("LATE  | new", "x", "late")
    fan = {r.milestone_id: r for r in attribute_fanout(eav, spark.range(1, 4).toDF("milestone_id"), text_collation=CI).collect()}
    assert [(x["value"], x["times"]) for x in fan[1].Milestone_Owner] == [("LATE ", 2), ("new", 1)]
    assert [(int(fan[i].literal_rows), int(fan[i].distinct_rows)) for i in (1, 2, 3)] == [(3, 2), (2, 2), (1, 1)]
    roles = spark.createDataFrame([(1, None, 5, 1), (1, None, 5, 2)], "roadmap_id bigint, project_id bigint, role int, user_id bigint")
    users = spark.createDataFrame([(1, "Doe", None), (2, "DOE", " ")], "user_id bigint, last_name string, first_name string")
    assert [r.holder for r in named_roles(roles, users, {5: "roadmap_id"}, CI).collect()] == ["DOE "]


def test_spellings_merge_without_a_collated_group_or_shuffle(spark):
    """The collation is asked only for values of one attribute of one milestone, not for every row of a sort or shuffle."""
    r = random.Random(4)
    texts = ["late", "LATE ", "Late", "new", "NEW  ", "stra\u00dfe", "STRASSE", "\u00e9t\u00e9", "E\u0301TE\u0301", "\u00c9T\u00c9 ", "", " ", None]
    data = [(r.randrange(9), r.randrange(1, 9), r.choice(texts)) for _ in range(500)]
    eav = spark.createDataFrame(data, "milestone_id bigint, attribute_id int, text_value string").repartition(5)
    want = {}
    for m, a, first, n in eav.groupBy("milestone_id", "attribute_id", F.collate("text_value", CI).alias("one")).agg(
            F.min("text_value"), F.count("*")).drop("one").collect():
        want.setdefault((m, a), []).append((first, n))
    fan = attribute_fanout(eav, spark.range(10).toDF("milestone_id"), text_collation=CI)
    pivot = attribute_pivot(eav, text_collation=CI)
    for df in (fan, pivot):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and not re.search(r"hashpartitioning\([^)]*(collate|_group|one_value)", plan, re.IGNORECASE)
    for row in fan.collect():
        for k, name in NARRATIVE_ATTRIBUTES.items():
            cell = want.get((row.milestone_id, k), [])
            assert [tuple(x) for x in row[name]] == sorted(cell, key=lambda x: (x[0] is not None, x[0] or ""))
    for row in pivot.collect():
        for k, name in NARRATIVE_ATTRIBUTES.items():
            cell = sorted(v for v, _ in want.get((row.milestone_id, k), []) if v is not None)
            assert row[name] == (" | ".join(cell) if cell else None)


def test_a_merge_compares_the_base_impact_under_the_collation(spark):
    schema = C.cache_schema()

    def rows(*keys):
        full = dict.fromkeys(C.CACHE_COLUMNS)
        return spark.createDataFrame([tuple({**full, **dict.fromkeys(C.MERGE_KEY[:3], 1), "A_ROADMAP_SUBSET_HASH": 1, "P_ID": 1,
                                            "A_LAST_MODIFIED_FOR_CACHE_UTC": None, "A_FK_Milestone": m,
                                            "A_FK_BASE_IMPACT": b}.values()) for m, b in keys], schema).withColumn(
            "A_LAST_MODIFIED_FOR_CACHE_UTC", F.lit("2024-01-01").cast("timestamp_ntz"))

    old, new = rows((1, "N3"), (2, "N3"), (3, None)), rows((1, "n3 "), (2, "N4"), (3, None), (4, "n3"))
    assert sorted(r.A_FK_Milestone for r in C.rows_to_insert(new, old, CI).collect()) == [2, 3, 4]
    assert sorted(r.A_FK_Milestone for r in C.rows_to_insert(new, old).collect()) == [1, 2, 3, 4]


def test_spelling_changes_nothing_but_the_shown_key(spark):
    tables = derive_tables(spark, "/root/testdata/sf0.001")

    def rows(t, p):
        return sorted(report_rows(t, p).drop("A_FK_BASE_IMPACT").select("A_FK_Milestone", "RM_OWNER", "WS_OWNER", "Plan", "Milestone_Owner")
                      .collect(), key=str)

    plain, typed = rows(tables, P_COLLATED), rows(_spelled(tables), P_COLLATED)
    assert plain == typed and plain
    assert rows(_spelled(tables), P_COLLATED.with_(text_collation=None)) == []  # binary: nothing is called 'n3 '
