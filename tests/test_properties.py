"""Property tests: the label functions against plain-Python statements of the same
rules, on many generated rows evaluated in one Spark job each."""

import datetime as dt
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tollgate.functions.labels import day_diff, person_name, sort_segment, traffic_light

SETTINGS = settings(max_examples=5, deadline=None)

names = st.one_of(st.none(), st.sampled_from(["", " ", "  ", "Ann", " Bo ", "de la Cruz"]),
                  st.text(alphabet="abcXYZ ,", max_size=6))


def py_person(last, first):
    blank = first is None or first.strip(" ") == ""
    return (last or "") + ("" if blank else ", ") + (first or "")


def py_segment(x: Decimal) -> str:
    return "::" + ("000" + str(int(x)))[-3:]


@SETTINGS
@given(st.lists(st.tuples(names, names), min_size=1, max_size=200))
def test_person_name_property(spark, rows):
    df = spark.createDataFrame(rows, "l string, f string")
    got = [r[0] for r in df.select(person_name(F.col("l"), F.col("f"))).collect()]
    assert got == [py_person(a, b) for a, b in rows]


@SETTINGS
@given(st.lists(st.decimals(min_value=0, max_value=99999, places=2, allow_nan=False), min_size=1, max_size=200))
def test_sort_segment_property(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x decimal(10,2)")
    got = [r[0] for r in df.select(sort_segment(F.col("x"))).collect()]
    assert got == [py_segment(x) for x in xs]


@SETTINGS
@given(st.lists(st.tuples(st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2030, 1, 1)),
                          st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2030, 1, 1))),
                min_size=1, max_size=200))
def test_day_diff_property(spark, pairs):
    df = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
    got = [r[0] for r in df.select(day_diff(F.col("a"), F.col("b"))).collect()]
    assert got == [(b.date() - a.date()).days for a, b in pairs]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(min_value=-3, max_value=9)), min_size=1, max_size=100))
def test_traffic_light_property(spark, codes):
    df = spark.createDataFrame([(c,) for c in codes], "c int")
    got = [r[0] for r in df.select(traffic_light(F.col("c"))).collect()]
    labels = {1: "Black", 2: "White", 3: "Green", 4: "Yellow"}
    assert got == [labels.get(c, "Red") for c in codes]
