"""The pipeline's stages: columns, decisions, whole input, and odd tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from llm.conftest import SF, edge_rows, words
from tollgate.llm.common import apply_copies
from tollgate.llm.mixing import mix
from tollgate.llm.sharding import place


def test_stages_over_documents(spark, documents, tmp_path):
    docs, counts = documents, [documents.count()]
    for k, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == documents.columns and out.dtypes == documents.dtypes
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
    distinct = documents.select(F.lower("text")).distinct().count()
    assert counts[1] == counts[0]  # every test document has letters of a learned language
    assert counts[3] < counts[2] <= distinct
    assert docs.where("not exact").count() == 0
    taken = spark.read.parquet(str(tmp_path / "mixing")).groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert taken == 2


def test_run_writes_and_rereads(spark):
    assert {"doc_id", "ids", "n_tokens", "exact"} <= set(C.run(spark, "/root/testdata/sf0.001").columns)


def test_stages_on_odd_tables(spark, edge, none, tmp_path):
    docs = edge.select("doc_id", "text", "lang", "source", "n_chars")
    for k, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k == 0:
            assert {2, 8, 9, 12, 1}.isdisjoint(r.doc_id for r in docs.collect())
        if k == 1:
            texts = [r.text.lower() for r in docs.collect()]
            assert len({t for t in texts}) >= len(texts) - 1
    empty = none.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in C.STAGES:
        assert stage(spark, empty, SF).count() == 0


CLASHING = ["_slot", "_key", "_copies", "_n", "_copy", "_found", "_ID", "_decided_key", "_rows", "copies", "row", "text_key"]


def test_columns_with_the_names_of_helpers_are_kept(spark):
    """Every stage but the last, and sharding, hand on columns named like their own helpers'."""
    rows = [(i, words(i % 4, 30), "en", f"s{i % 2}", *[f"{c}{i}" for c in CLASHING]) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, "
                                 + ", ".join(f"`{c}` string" for c in CLASHING))
    given = {tuple(r) for r in rows}
    for name, stage in C.STAGES[1:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        got = [tuple(r) for r in out.collect()]
        assert got and set(got) <= given, name
    out = C.identify_language(spark, docs, SF)
    assert out.columns == docs.columns and {tuple(r) for r in out.collect()} <= given
    placed = place(docs, "doc_id", ["a", "b"])
    assert placed.columns == [*docs.columns, "shard"] and {tuple(r)[:-1] for r in placed.collect()} == given


@pytest.mark.parametrize("bound", [True, False])
def test_copies_of_repeated_rows(spark, edge, bound, monkeypatch):
    if not bound:  # the way beyond the broadcast
        monkeypatch.setattr("tollgate.llm.common.fits_broadcast", lambda *a: False)
    decided = edge.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), F.lit(2).alias("copies"))
    got = Counter((r.doc_id, r.text) for r in apply_copies(edge, decided).collect())
    want = Counter({k: 2 * n for k, n in Counter((r[0], r[1]) for r in edge_rows()).items()})
    assert got == want
    mixed = mix(edge)
    total = mixed.agg(F.sum("copies")).first()[0]
    assert apply_copies(edge, mixed).count() == total


def test_workers_need_no_copy_of_the_repository(tmp_path):
    """Started elsewhere, with the repository on the driver's path alone."""
    import os
    import pathlib
    import subprocess
    import sys

    root = pathlib.Path(C.__file__).resolve().parent
    code = f"""
import sys; sys.path.insert(0, {str(root)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__ as e
for name in ("op4_toxicity", "op5_byte_bpe", "op7_near_dedup", "op8_mixing", "op10_language_id"):
    print(name, e.queries()[name](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert out.stdout.count(" 200") == 5, out.stderr[-2000:]


def test_texts_go_to_the_workers_in_small_batches(spark, documents):
    """Ten thousand texts a batch filled both sides' memory; a session's own number stays."""
    key, tokenize = "spark.sql.execution.arrow.maxRecordsPerBatch", dict(C.STAGES)["byte_bpe"]
    before = spark.conf.get(key)
    try:
        for own, used in (("10000", "1000"), ("77", "77")):
            spark.conf.set(key, own)
            assert tokenize(spark, documents.limit(3), SF).count() == 3
            assert spark.conf.get(key) == used
    finally:
        spark.conf.set(key, before)
