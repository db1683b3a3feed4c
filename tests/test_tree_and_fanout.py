"""Pre-order by list ranking, and the attribute joins in factorised form."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from literal import literal_attribute_joins
from tollgate.operators.attributes import NARRATIVE_COLUMNS, attribute_fanout
from tollgate.operators.hierarchy import tree_path
from tollgate.operators.tree_order import tree_order

NODES = "base_impact_id string, parent_id string, program_id int, sort_order double"


def walked(rows, program):
    """Pre-order by recursion on a stack: {id: (position, depth)}."""
    def key(r):
        return ("::" + ("000" + str(int(r[3])))[-3:], r[0])

    children = {}
    for r in rows:
        children.setdefault(r[1], []).append(r)
    out, stack = {}, [(r, 1) for r in sorted((r for r in children.get(None, []) if r[2] == program), key=key, reverse=True)]
    while stack:
        r, depth = stack.pop()
        out[r[0]] = (len(out) + 1, depth)
        stack += [(c, depth + 1) for c in sorted(children.get(r[0], []), key=key, reverse=True)]
    return out


def ordered(spark, rows, program=1):
    got = tree_order(spark, spark.createDataFrame([(*r[:3], float(r[3])) for r in rows], NODES), program).collect()
    return {r.base_impact_id: (r.position, r.depth) for r in got}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_forests_match_a_walk(spark, seed):
    r = random.Random(seed)
    rows = [(f"n{i}", None if i < 4 else r.choice([f"n{r.randrange(i)}", f"n{i - 1}", "n2", "gone" if i % 40 == 0 else "n0"]),
             r.randrange(2) if i > 1 else 1, r.randrange(4) + r.random()) for i in range(150)]
    r.shuffle(rows)
    assert ordered(spark, rows) == walked(rows, 1)


def test_order_equals_the_sort_paths_where_sort_keys_are_unique(spark):
    r = random.Random(3)
    rows = [(f"n{i}", None if i == 0 else f"n{r.randrange(i)}", 1, i) for i in range(200)]
    df = spark.createDataFrame([(*r[:3], float(r[3])) for r in rows], NODES)
    paths = {x.base_impact_id: (x.sort_path, x.depth) for x in tree_path(spark, df, 1).collect()}
    got = ordered(spark, rows)
    assert sorted(paths, key=lambda i: paths[i][0]) == sorted(got, key=lambda i: got[i][0])
    assert {i: d for i, (_, d) in paths.items()} == {i: d for i, (_, d) in got.items()}


def test_a_chain_of_five_thousand_levels(spark):
    rows = [(f"n{i:05d}", None if i == 0 else f"n{i - 1:05d}", 1, 1) for i in range(5000)]
    random.Random(1).shuffle(rows)
    assert ordered(spark, rows) == {f"n{i:05d}": (i + 1, i + 1) for i in range(5000)}


def test_cycles_empty_trees_and_bad_ids(spark):
    tree = [("a", None, 1, 1), ("b", "a", 1, 1)]
    with pytest.raises(ValueError, match="cycle.*x, y, z"):
        ordered(spark, tree + [("x", "y", 1, 1), ("y", "x", 1, 1), ("z", "y", 1, 1)])
    with pytest.raises(ValueError, match="cycle.*x"):
        ordered(spark, tree + [("x", "x", 1, 1)])
    for more in ([("a", "b", 1, 2)], [(None, "a", 1, 2)]):
        with pytest.raises(ValueError, match="repeats an id"):
            ordered(spark, tree + more)
    assert ordered(spark, []) == {} == ordered(spark, tree, program=2)
    assert ordered(spark, [*tree, ("o", None, None, 1), ("p", "o", 1, 1)]) == {"a": (1, 1), "b": (2, 2)}


def test_fanout_counts_equal_the_literal_joins(spark):
    r = random.Random(8)
    data = [(r.randrange(12), r.randrange(1, 9), r.choice(["a", "b", "c", None])) for _ in range(150)]
    eav = spark.createDataFrame(data, "milestone_id bigint, attribute_id int, text_value string")
    ms = spark.range(14).withColumnRenamed("id", "milestone_id")
    joined = literal_attribute_joins(ms, eav)
    want = {x.milestone_id: (x.n, x.d) for x in joined.groupBy("milestone_id").agg(
        F.count("*").alias("n"), F.count_distinct(F.struct(*NARRATIVE_COLUMNS)).alias("d")).collect()}
    fan = attribute_fanout(eav, ms).collect()
    assert {x.milestone_id: (int(x.literal_rows), int(x.distinct_rows)) for x in fan} == want
    # the multiplicity of every joined row is the product of its values' times
    times = {x.milestone_id: [{v["value"]: v["times"] for v in x[c]} or {None: 1} for c in NARRATIVE_COLUMNS] for x in fan}
    rows = Counter(tuple(x) for x in joined.where("milestone_id < 6").collect())
    for (m, *values), n in rows.items():
        product = 1
        for own, v in zip(times[m], values):
            product *= own[v]
        assert product == n


def test_fanout_of_a_milestone_with_very_many_combinations(spark):
    """Seven attributes of a thousand values: 10^21 rows, told from seven lists."""
    eav = spark.range(7000).select(F.lit(1).cast("bigint").alias("milestone_id"), (F.col("id") % 7 + 1).cast("int").alias("attribute_id"),
                                   F.col("id").cast("string").alias("text_value"))
    (x,) = attribute_fanout(eav, spark.createDataFrame([(1,)], "milestone_id bigint")).collect()
    assert x.literal_rows == x.distinct_rows == 10**21 and len(x.Milestone_Owner) == 1000
