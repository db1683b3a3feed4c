"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as E
from tollgate.checks.compare import compare, duckdb_conn
from tollgate.plans.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF)


def test_every_report_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(E.queries()[name](spark, SF), con, E.oracle_sql()[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 48


def test_entry_without_the_llm_folders(tmp_path):
    """The report's queries stand alone when the optional subpackage is gone."""
    import pathlib
    import shutil
    import subprocess
    import sys

    root = pathlib.Path(E.__file__).resolve().parent
    shutil.copytree(root / "tollgate", tmp_path / "tollgate", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    (tmp_path / "tollgate" / "llm").mkdir()  # an empty folder left behind
    code = "import __spark_entry__ as e; print(*e.queries(), *set(e.queries()) - set(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert set(out.stdout.split()) == set(QUERIES)
