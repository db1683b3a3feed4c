"""Milestone attributes: entity-attribute-value rows pivoted to one column each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.operators.joins import KeyBound, key_bounds, semi_join_keys

# Attribute id -> report column (the seven narrative attributes).
NARRATIVE_ATTRIBUTES = {
    1: "Milestone_Owner",
    2: "Project_Status_Rationale",
    3: "Project_Decisions_Needed",
    4: "Project_TMO_Comments",
    5: "Project_Actions_for_Next_Week",
    6: "Project_Actions_from_Last_Week",
    7: "Roadmap_Interdependency",
}
NARRATIVE_COLUMNS = list(NARRATIVE_ATTRIBUTES.values())
# Several values for one (milestone, attribute) are listed in one cell, sorted.
VALUE_SEPARATOR = " | "


def attribute_pivot(milestone_attribute: DataFrame, milestones: DataFrame | None = None,
                    n_milestones: KeyBound | None = None, attribute_ids: dict | None = None,
                    text_collation: str | None = None) -> DataFrame:
    """One row per milestone with a column per narrative attribute.

    A milestone with one value for an attribute gets that value; with several
    values, their distinct values sorted and joined by ' | ' (one row, not one row
    per combination); with none, NULL. `milestones` (a frame with milestone_id)
    restricts the pivot to those milestones; with its checked size (`n_milestones`)
    within the broadcast budget by a broadcast semi join inside the scan stage, else by
    a shuffled one. `attribute_ids` maps attribute ids to columns. Values that are equal under
    `text_collation` are one value, spelled as the first of them in binary order.

    The distinct (milestone, attribute, value) rows come first, by a hash aggregate
    that merges a hot milestone's repeats in every task before the shuffle; only the
    distinct values of a milestone, which are its cells, are then brought together.
    """
    ids = attribute_ids or NARRATIVE_ATTRIBUTES
    names = list(ids.values())
    eav = milestone_attribute.where(F.col("attribute_id").isin(list(ids)))
    if milestones is not None:
        eav = semi_join_keys(eav, milestones, "milestone_id", n_milestones or key_bounds(milestones, "milestone_id")["milestone_id"])
    values = eav.select("milestone_id", "attribute_id", "text_value").distinct()
    cells = attribute_cells(values.withColumn("times", F.lit(1).cast("bigint")), text_collation)
    lists = cells.select("milestone_id", *[
        F.transform(F.filter("_cells", is_value_of(k)), lambda x: x["value"]).alias(name) for k, name in ids.items()])
    folded = [
        F.when(F.size(name) > 0, F.array_join(F.array_sort(name), VALUE_SEPARATOR)).alias(name)
        for name in names
    ]
    return lists.select("milestone_id", *folded)


def is_entry_of(attribute_id: int) -> Callable[[Column], Column]:
    return lambda x: x["attribute_id"] == attribute_id


def is_value_of(attribute_id: int) -> Callable[[Column], Column]:
    return lambda x: (x["attribute_id"] == attribute_id) & x["value"].isNotNull()


def attribute_cells(times: DataFrame, text_collation: str | None = None) -> DataFrame:
    """One row per milestone with `_cells`, a list of (attribute_id, value, times), from distinct rows (milestone_id,
    attribute_id, text_value) with their times. Values that are equal under `text_collation` are one entry."""
    # one shuffle of plain rows: they are spread over all tasks, so partial lists would hold one row each
    lists = times.repartition("milestone_id").groupBy("milestone_id").agg(
        F.collect_list(F.struct("attribute_id", F.col("text_value").alias("value"), "times")).alias("_cells"))
    return merged_spellings(lists, "_cells", text_collation)


def merged_spellings(cells: DataFrame, column: str, collation: str | None) -> DataFrame:
    """Rows whose list `column` of (attribute_id, value, times) has one entry for the values of an attribute that are equal
    under the collation: the first spelling in binary order, with the sum of their times.

    The collation's library compares behind one lock for all tasks of an executor, and a shuffle or group by a
    collated text asks it several times a row. Here it is asked only for two values of one attribute of one row: the
    list is sorted by attribute, value under the collation and spelling, and each run of equal values is one slice.
    """
    if collation is None:
        return cells
    kept = [c for c in cells.columns if c != column]
    order = F.sort_array(F.transform(column, lambda x: F.struct(
        x["attribute_id"].alias("attribute_id"), F.collate(x["value"], collation).alias("one_value"), x["value"].alias("value"), x["times"].alias("times"))))
    at = F.col("_sorted")

    def first(x: Column, i: Column) -> Column:
        before = F.get(at, i - 1)
        return (i == 0) | (x["attribute_id"] != before["attribute_id"]) | ~x["one_value"].eqNullSafe(before["one_value"])

    firsts = F.filter(F.transform("_sorted", lambda x, i: F.when(first(x, i), i)), lambda i: i.isNotNull())

    def run(i: Column, nth: Column) -> Column:
        end = F.coalesce(F.get(F.col("_firsts"), nth + 1), F.size("_sorted"))
        x = F.get(at, i)
        total = F.aggregate(F.slice("_sorted", i + 1, end - i), F.lit(0).cast("bigint"), lambda n, y: n + y["times"])
        return F.struct(x["attribute_id"].alias("attribute_id"), x["value"].alias("value"), total.alias("times"))

    ordered = cells.select(*kept, order.alias("_sorted"))
    marked = ordered.select(*kept, "_sorted", firsts.alias("_firsts"))
    return marked.select(*kept, F.transform("_firsts", run).alias(column))


def attribute_fanout(milestone_attribute: DataFrame, milestones: DataFrame, attribute_ids: dict | None = None,
                     text_collation: str | None = None) -> DataFrame:
    """The source's seven attribute joins in factorised form: per milestone of `milestones` (milestone_id, once each),
    a list per attribute of (value, times), sorted, plus `literal_rows`, the rows those joins give,
    and `distinct_rows`, how many of them differ.

    A joined row takes one value of each attribute, so it stands there as often as the product of its
    values' times, and the rows are the product of the lists' sums; an attribute without
    rows counts once, with NULL. The lists say everything the product does in the sum of their
    sizes: no combination is ever made. Repeats are merged in every task before the
    shuffle. A count beyond 38 digits is an error. Values that are equal under
    `text_collation` are one value, as in `attribute_pivot`.
    """
    ids = attribute_ids or NARRATIVE_ATTRIBUTES
    names = list(ids.values())
    times = milestone_attribute.where(F.col("attribute_id").isin(list(ids))).groupBy(
        "milestone_id", "attribute_id", "text_value").agg(F.count("*").alias("times"))
    cells = attribute_cells(times, text_collation)
    lists = cells.select("milestone_id", *[
        F.sort_array(F.transform(F.filter("_cells", is_entry_of(k)), lambda x: F.struct(x["value"], x["times"]))).alias(name)
        for k, name in ids.items()])
    one = F.lit(1).cast("decimal(38,0)")
    rows, different = one, one
    for name in names:
        n = F.aggregate(name, F.lit(0).cast("bigint"), lambda total, x: total + x["times"])
        rows = (rows * F.when(F.size(name) > 0, n).otherwise(1).cast("decimal(19,0)")).cast("decimal(38,0)")
        different = (different * F.when(F.size(name) > 0, F.size(name)).otherwise(1).cast("decimal(10,0)")).cast("decimal(38,0)")
    empty = F.array().cast(lists.schema[names[0]].dataType)
    whole = milestones.select("milestone_id").join(lists, "milestone_id", "left").select(
        "milestone_id", *[F.coalesce(F.col(name), empty).alias(name) for name in names])
    return whole.withColumn("literal_rows", rows).withColumn("distinct_rows", different)
