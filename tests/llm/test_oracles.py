"""Every query that SQL can express, against its DuckDB oracle."""

import pytest

import __spark_entry__ as E
from llm.conftest import SF
from tollgate.checks.compare import compare, duckdb_conn
from tollgate.llm import oracles
from tollgate.llm.queries import LLM_ORACLES, LLM_QUERIES, labelled_urls
from tollgate.llm.url_filter import judge_urls


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF)


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(E.queries()[name](spark, SF), con, E.oracle_sql()[name])
    assert ok, msg


def test_mined_rules_match_oracle_where_many_fire(spark, con):
    pages, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("pages", "labels"))
    got = judge_urls(pages, labelled_urls(pages, labels), min_support=0.05, min_confidence=0.2, min_count=3)
    assert got.where("mined_rule is not null").count() > 20
    ok, msg = compare(got, con, oracles._url_filter(0.05, 0.2, 3))
    assert ok, msg


def test_registered_queries():
    assert {f"op{n}_" for n in range(1, 14)} == {n.split("_")[0] + "_" for n in LLM_QUERIES}
    assert "pipeline" in E.queries()
