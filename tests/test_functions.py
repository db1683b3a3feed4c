import datetime as dt
import html
import html.entities
import re
from decimal import Decimal
from html.parser import HTMLParser

from pyspark.sql import functions as F

from tollgate.functions.html import decode_references, strip_html
from tollgate.functions.labels import (
    day_diff,
    flag,
    person_name,
    project_url,
    roadmap_url,
    sentinel_datetime,
    sort_segment,
    traffic_light,
)


def one(spark, expr, ddl, rows):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(expr).collect()]


def test_sort_segment_keeps_last_three_digits(spark):
    rows = [(Decimal("1.7"),), (Decimal("1234"),), (Decimal("7"),)]
    out = one(spark, sort_segment(F.col("x")), "x decimal(10,2)", rows)
    assert out == ["::001", "::234", "::007"]


def test_traffic_light_null_and_unknown_are_red(spark):
    out = one(spark, traffic_light(F.col("x")), "x int", [(1,), (2,), (3,), (4,), (5,), (None,)])
    assert out == ["Black", "White", "Green", "Yellow", "Red", "Red"]


def test_person_name(spark):
    rows = [("Last", "First"), ("Last", None), ("Last", "  "), (None, None)]
    out = one(spark, person_name(F.col("l"), F.col("f")), "l string, f string", rows)
    assert out == ["Last, First", "Last", "Last  ", ""]


def test_flag_null_is_false(spark):
    assert one(spark, flag(F.col("x") == 2), "x int", [(2,), (1,), (None,)]) == [True, False, False]


def test_day_diff_counts_calendar_boundaries(spark):
    rows = [(dt.datetime(2024, 1, 1, 23, 0), dt.datetime(2024, 1, 2, 1, 0))]
    assert one(spark, day_diff(F.col("a"), F.col("b")), "a timestamp_ntz, b timestamp_ntz", rows) == [1]


def test_sentinel_year(spark):
    rows = [(dt.date(1900, 5, 1),), (dt.date(1901, 1, 1),), (None,)]
    out = one(spark, sentinel_datetime(F.col("d")), "d date", rows)
    assert out == [None, dt.datetime(1901, 1, 1), None]


def test_urls(spark):
    df = spark.createDataFrame([(5, None), (15, 10)], "p bigint, parent bigint")
    got = df.select(project_url(F.lit(1), F.col("p"), F.col("parent"))).collect()
    assert [r[0] for r in got] == ["ng-program-tree/project?programId=1&projectId=",
                                   "ng-program-tree/project?programId=1&projectId=15"]
    got = one(spark, roadmap_url(F.lit(1), F.col("r")), "r bigint", [(42,), (None,)])
    assert got == ["ng-program-tree/initiative?programId=1&roadmapId=42", None]


def test_strip_html_whole_text(spark):
    page = ("<html><head><style>p{x:1}</style><script>var t='</p>';</script></head><body><!-- c -->"
            "<p>Fish &amp; chips&nbsp;&lt;3</p>\n\n<p>end</p></body></html>")
    assert one(spark, strip_html(F.col("h")), "h string", [(page,)]) == ["Fish & chips <3 end"]
    long = "<p>" + " ".join(["word"] * 50000) + "</p>"
    out = one(spark, strip_html(F.col("h")), "h string", [(long,)])[0]
    assert out.count("word") == 50000


class VisibleText(HTMLParser):
    """The standard library's reading of a page: its text outside script and style."""

    def __init__(self):
        super().__init__()
        self.parts, self.raw = [], False

    def handle_starttag(self, tag, attrs):
        self.raw = tag in ("script", "style")
        self.parts.append(" ")

    def handle_endtag(self, tag):
        self.raw = False
        self.parts.append(" ")

    def handle_data(self, data):
        if not self.raw:
            self.parts.append(data)

    def handle_other(self, data):
        self.parts.append(" ")

    handle_comment = handle_decl = handle_pi = unknown_decl = handle_other


def visible(page):
    parser = VisibleText()
    parser.feed(page)
    parser.close()
    return re.sub("[ \t\n\r\f\u00a0]+", " ", "".join(parser.parts)).strip(" ")


def test_references_equal_the_standard_library(spark):
    texts = [f"a&{name}b &{name}" for name in html.entities.html5]
    texts += [f"&#{n};&#x{n:X};&#{n} x" for n in (*range(0, 0x180), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFEFF, 0xFFFD, 0xFFFE,
                                                  0xFFFF, 0x10000, 0x1F600, 0x1FFFE, 0x10FFFF, 0x110000, 10**7, 10**30)]
    texts += ["", "&", "&&amp;&", "&amp;lt;", "&#;", "&#x;", "&#xg", "&#0065;", "&#x00041", "&notit;", "&notin;", "&ampamp;", "&unknown;",
              "&am", "&" + "a" * 40 + ";", "&#X41;&#X41g", "&copy&copy;2", "AT&T &lt<b>", "&\tamp;", "&lt\n;", None]
    got = one(spark, decode_references(F.col("h")), "h string", [(t,) for t in texts])
    assert got == [None if t is None else html.unescape(t) for t in texts]


def test_visible_text_equals_the_standard_library_on_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html", strip_html(F.col("html")).alias("text"))
    wrong = [(r.html[-200:], r.text[-200:], visible(r.html)[-200:]) for r in pages.collect() if r.text != visible(r.html)]
    assert not wrong, (len(wrong), wrong[:2])


def test_visible_text_of_nested_and_unclosed_markup(spark):
    cases = {
        None: None, "": "", "  plain  text ": "plain text",
        "a<script>x<!-- </script>b --> c": "a b --> c",              # a comment inside a script is script
        "a<!-- <script> --> b </script>c": "a b c",                  # a script inside a comment is comment
        "a<style>p</script>q</style>b": "a b",                       # only its own end tag closes it
        "a<script>x</style>y": "a",                                  # never closed
        "a<!-- never closed <p>b": "a",
        "a<p class='x": "a",
        "a<SCRIPT type='t'>x</Script >b": "a b",
        "a<scripted>b</scripted>": "a b",
        "1 < 2 and 3 > 2": "1 < 2 and 3 > 2",                        # no tag starts with a blank
        "<!DOCTYPE html><p>a&lt;b&gt;</p>": "a<b>",                  # decoded text is not markup
        "x&nbsp;&#160; y": "x y",
    }
    got = one(spark, strip_html(F.col("h")), "h string", [(t,) for t in cases])
    assert got == list(cases.values())


def test_distinct_rows_under_collation(spark):
    from tollgate.functions.text import distinct_rows

    df = spark.createDataFrame([("abc", 1), ("ABC ", 1), ("abd", 2), (None, 3)], "s string, n int")
    assert distinct_rows(df).count() == 4
    out = distinct_rows(df, "UNICODE_CI_RTRIM")
    assert out.count() == 3
    assert out.schema.simpleString() == "struct<s:string,n:int>"


def test_scale_conf_for_100_tb():
    from tollgate.session import scale_conf

    c = scale_conf(100 * 2**40)
    assert c["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    assert int(c["spark.sql.shuffle.partitions"]) == 40960   # 10 TB shuffled / 256 MB
    assert int(scale_conf(10 * 2**30)["spark.sql.shuffle.partitions"]) == 200  # small runs keep the floor
