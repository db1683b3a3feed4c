"""Language ID, toxicity, BPE and mixing: held-out accuracy, round trips, invariants, brute force."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from llm.conftest import SF, edge_rows, words
from tollgate.llm import byte_bpe as B
from tollgate.llm import language_id as L
from tollgate.llm import mixing as M
from tollgate.llm import toxicity as T
from tollgate.llm.queries import LLM_QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


# ---- language ID ------------------------------------------------------------

def test_language_held_out_accuracy(spark, document_rows):
    got = {r.doc_id: r for r in LLM_QUERIES["op10_language_id"](spark, SF).collect()}
    truth = {r[0]: r[2] for r in document_rows}
    assert got.keys() == truth.keys()
    out = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in got.items() if r.held_out} == set(out)
    assert np.mean([got[i].lang_pred == truth[i] for i in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_model_never_sees_held_out_rows(spark, documents):
    """Spoiling the languages of held-out rows changes nothing."""
    docs = documents.withColumn("held_out", L.held_out(F.col("doc_id")))
    spoiled = docs.withColumn("lang", F.when(F.col("held_out"), F.lit("zz")).otherwise(F.col("lang")))
    a, b = (L.fit(x.where("not held_out"), ["doc_id"]) for x in (docs, spoiled))
    assert a.languages == b.languages and np.allclose(a.weights, b.weights, atol=1e-4)


def brute_kernel(a, b):
    def grams(t):
        folded = [0 if not c.isalpha() else (ord(c) - 96 if c.isascii() else 27 + ord(c) % 32) for c in t.lower()]
        s = [0, *folded, 0]
        s = [c for k, c in enumerate(s) if k == 0 or c or s[k - 1]]
        return {tuple(s[i:i + n]) for n in L.ORDERS for i in range(len(s) - n + 1)}
    x, y = grams(a), grams(b)
    return len(x & y) / (len(x) * len(y)) ** 0.5


def test_kernel_matches_brute_force():
    texts = ["Hello, world!", "été à  l'école", "hello hello", "123 a", "straße ÜBER"]
    marks = L.Landmarks.of(texts[:3])
    presence, own = marks.rows(texts, L.Grams())
    k = (presence @ marks.matrix) * own[:, None]
    assert np.allclose(k, [[brute_kernel(a, b) for b in texts[:3]] for a in texts], atol=1e-6)


def test_language_edge_cases(edge, none):
    model = L.fit(edge, ["doc_id"])
    got = L.predict(edge, model, ["doc_id", "n_chars"]).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in edge_rows())
    for r in got:
        if r.doc_id in (1, 2, 8, 9, 12) or (r.doc_id is None and r.n_chars is None):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("en", "de", "fr")
    empty = L.fit(none, ["doc_id"])
    assert {r.lang_pred for r in L.predict(edge, empty, ["doc_id"]).collect()} == {"und"}
    assert L.predict(none, model, ["doc_id"]).count() == 0


# ---- toxicity ---------------------------------------------------------------

def test_toxic_documents_are_found(spark):
    """Held-out labels: the model is fitted on half of the labelled rows."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2
    sample = T.labelled_sample(docs, labels.where(half == 0), "doc_id", "toxic")
    model = T.fit(T.density_grades(sample))
    got = T.score(docs.join(labels.where(half == 1), "doc_id"), model, ["doc_id", "toxic"]).collect()
    hit = Counter((r.toxic, r.is_toxic) for r in got)
    assert hit[1, True] > 0.9 * (hit[1, True] + hit[1, False])
    assert hit[0, True] < 0.01 * (hit[0, True] + hit[0, False])
    mean = {t: np.mean([r.expected_severity for r in got if r.toxic == t]) for t in (0, 1)}
    assert mean[1] > mean[0] + 0.5


def test_sample_is_bounded_and_skips_null_labels(spark, edge, none):
    labels = spark.createDataFrame([(i, None if i == 7 else i % 2) for i in range(1000)] + [(None, 1)], "doc_id bigint, toxic int")
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    assert 150 < T.labelled_sample(docs, labels, "doc_id", "toxic", max_rows=200).count() < 260
    assert T.labelled_sample(docs, labels, "doc_id", "toxic").count() == 999
    assert T.labelled_sample(edge, labels, "doc_id", "toxic").count() == sum(
        1 for r in edge_rows() if r[0] is not None and 0 <= r[0] < 1000 and r[0] != 7)
    assert T.labelled_sample(none, labels, "doc_id", "toxic").count() == 0


def test_sample_keeps_rare_labels(spark):
    """As many of a rare label as the bound allows, whatever its share of the labels."""
    labels = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 100 == 0).cast("int").alias("toxic"))
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    for max_rows, toxic, clean in [(2000, 200, 1800), (200, 100, 100)]:
        got = {r.label: r["count"] for r in T.labelled_sample(docs, labels, "doc_id", "toxic", max_rows=max_rows)
               .groupBy("label").count().collect()}
        assert abs(got[1] - toxic) <= (0 if toxic == 200 else 40) and abs(got[0] - clean) < 200
    assert T.label_bounds({0: 10, 1: 3, 2: 50}, 30) == {0: 10, 1: 3, 2: 17}
    assert T.label_bounds({}, 30) == {}


def test_grades_share_weights_across_thresholds(spark):
    """Three grades by the density of bad words: expected severity rises with it."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(600):
        grade = i % 3
        w = words(i, 60).split()
        for k in rng.choice(60, size=grade * 6, replace=False):
            w[k] = f"bad{rng.integers(4)}"
        rows.append((i, " ".join(w), grade))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, grade int")
    model = T.fit(df)
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    got = T.score(df, model, ["grade"]).collect()
    mean = [np.mean([r.expected_severity for r in got if r.grade == g]) for g in range(3)]
    assert mean[0] < 0.3 and mean[0] + 0.4 < mean[1] < mean[2] - 0.4
    assert all(abs(sum(r.grade_probabilities) - 1) < 1e-9 for r in got)


def test_ordinal_fit_is_a_minimum():
    """The fit ends where no change of one parameter lowers the loss."""
    rng = np.random.default_rng(0)
    rows, cols, vals = np.arange(30), rng.integers(0, 3, 30), rng.uniform(0.5, 2, 30)
    grade = np.minimum(2, cols + (rng.random(30) < 0.2))
    weight = np.ones(30)

    def loss(w, theta):
        s = vals * w[cols]
        cut = np.concatenate([[-50], theta, [50]])
        p = 1 / (1 + np.exp(s - cut[grade + 1])) - 1 / (1 + np.exp(s - cut[grade]))
        return -np.mean(np.log(p)) + 0.0005 * (w ** 2).sum()

    few = loss(*T.fit_ordinal(rows, cols, vals, grade, weight, 3, ridge=1e-3, steps=1))
    w, theta = T.fit_ordinal(rows, cols, vals, grade, weight, 3, ridge=1e-3, steps=3000, rate=0.03)
    best = loss(w, theta)
    assert best < few
    for k in range(3):  # a stationary point
        for d in (-0.05, 0.05):
            assert loss(w + d * (np.arange(3) == k), theta) > best - 1e-6
    for k in range(2):
        for d in (-0.05, 0.05):
            assert loss(w, theta + d * (np.arange(2) == k)) > best - 1e-6


def test_toxicity_edge_cases(spark, edge, none):
    model = T.fit(edge.withColumn("grade", F.lit(None).cast("int")))
    got = T.score(edge, model, ["doc_id"]).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in edge_rows())
    assert {(r.expected_severity, r.is_toxic) for r in got} == {(0.0, False)}
    assert T.score(none, model, ["doc_id"]).count() == 0
    assert len(T.fit(none.withColumn("grade", F.lit(1))).cells) == 0


def test_density_grades(spark):
    rows = [(i, words(i, 50) + (" nasty" * (1 + 5 * (i % 4 == 0)) if i % 2 == 0 else ""), int(i % 2 == 0)) for i in range(200)]
    got = T.density_grades(spark.createDataFrame(rows, "doc_id bigint, text string, label int")).collect()
    assert {r.text: r.grade for r in got} == {x: 0 if not t else 2 if i % 4 == 0 else 1 for i, x, t in rows}


def test_toxicity_query_rows(spark, document_rows):
    got = LLM_QUERIES["op4_toxicity"](spark, SF).collect()
    assert len(got) == len(document_rows)
    assert all(len(r.grade_probabilities) == 3 and 0 <= r.expected_severity <= 2 for r in got)


# ---- byte-level BPE ---------------------------------------------------------

ODD = ["", "  ", "\n\n \t a", "héllo \U0001F600 世界 'S it's 12345 <|endoftext|>", "a" * 5000, "\x00\x01", "▁▁ <unk> </s>",
       "é" * 3000 + "  x", " " * 3000, "ab" * 50_000]


@pytest.fixture(scope="module")
def plain():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_query_matches_plain_encoder(spark, document_rows, plain):
    got = {r.doc_id: r for r in LLM_QUERIES["op5_byte_bpe"](spark, SF).collect()}
    assert len(got) == len(document_rows)
    for i, text, *_ in document_rows:
        ids = plain.encode_ordinary(text or "")
        r = got[i]
        assert r.n_tokens == len(ids) and r.exact
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_bpe_encode_and_decode_odd_texts(spark, name):
    path = public_tokenizers.path(name)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame([*enumerate(ODD), (None, None)], "doc_id bigint, text string")
    enc = B.encode(df, path, public_tokenizers.PATTERN)
    assert all(r.exact and r.n_tokens == len(r.ids) for r in enc.collect())
    rows = {r.doc_id: r.ids for r in enc.collect()}
    assert rows == {**{i: plain.encode_ordinary(t) for i, t in enumerate(ODD)}, None: []}
    back = {r.doc_id: bytes(r.decoded) for r in B.decode(enc, path, public_tokenizers.PATTERN).collect()}
    assert back == {**{i: t.encode() for i, t in enumerate(ODD)}, None: b""}


def test_bpe_edge_cases(edge, none):
    got = B.round_trip(edge, PATH, public_tokenizers.PATTERN).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in edge_rows()) and all(r.exact for r in got)
    assert B.round_trip(none, PATH, public_tokenizers.PATTERN).count() == 0


# ---- mixing -----------------------------------------------------------------

def target_reference(sizes):
    names = sorted((s for s in sizes if s is not None), key=str) + ([None] if None in sizes else [])
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(names)}
    fixed, total = {}, 1.5 * sum(sizes.values())
    while True:
        rest = [s for s in names if s not in fixed]
        left, w = total - sum(fixed.values()), sum(weight[s] for s in rest)
        share = {s: left * weight[s] / w for s in rest}
        over = [s for s in rest if share[s] > 2 * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: 2.0 * sizes[s] for s in over})


def n_words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def check_mix(got, rows, largest_left):
    size = defaultdict(int)
    for _, t, _, s in rows:
        size[s] += n_words(t)
    want = target_reference(size)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, n_words(t)) for i, t, _, _ in rows)
    source = {(i, n_words(t)): s for i, t, _, s in rows}
    taken = defaultdict(int)
    for r in got:
        s = source[r.doc_id, r.size]
        assert r.source_size == size[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[s] += r.taken
    for s in size:
        most = max((n_words(t) for _, t, _, x in rows if x == s), default=0)
        assert abs(taken[s] - want[s]) <= largest_left * most + 1e-6


def test_mix_query(spark, document_rows):
    a, b = (LLM_QUERIES["op8_mixing"](spark, SF).collect() for _ in range(2))
    check_mix(a, document_rows, 1)
    assert sorted(a) == sorted(b)


def test_mix_through_a_deep_tree_and_other_partitions(spark, documents, document_rows):
    """Groups of 8 and a fan-in of 3: many levels; a source is off by one document at most."""
    a = M.mix(documents, group_rows=8, fan_in=3).collect()
    check_mix(a, document_rows, 1)
    b = M.mix(documents.repartition(5), group_rows=8, fan_in=3).collect()
    assert sorted((r.doc_id, r.taken) for r in a) == sorted((r.doc_id, r.taken) for r in b)


def test_rows_alike_are_dealt_over_groups(spark, monkeypatch):
    """Half of a source shares id and text: no group is unbounded, and reruns agree."""
    rows = [(None, "one text of five words", "a")] * 2000 + [(i, words(i, 3 + i % 40), "ab"[i % 2]) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    sizes, round_groups = [], M._round_groups

    def seen(frame, *args):
        sizes.append(frame.groupBy("source_key", "group").count().agg(F.max("count")).first()[0])
        return round_groups(frame, *args)

    monkeypatch.setattr(M, "_round_groups", seen)
    runs = []
    for df in (docs, docs.repartition(7)):
        got = M.mix(df, group_rows=64).collect()
        assert len(got) == len(rows)
        assert abs(sum(r.taken for r in got) - 1.5 * sum(r.size for r in got)) < 100
        alike = [r.copies for r in got if r.doc_id is None]
        assert len(alike) == 2000 and max(alike) - min(alike) <= 1
        total = Counter()
        for r in got:
            total[r.doc_id, r.text_key] += r.copies
        runs.append(total)
    assert max(sizes) < 3 * 64
    assert runs[0] == runs[1]


def test_mix_edge_cases(edge, none):
    got = M.mix(edge).collect()
    rows = [(r[0], r[1], r[2], r[3]) for r in edge_rows()]
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, n_words(t)) for i, t, _, _ in rows)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    assert M.mix(none).count() == 0


def test_pivot_keeps_mass_and_expectation():
    size = np.array([5.0, 3, 8, 1, 2, 9])
    share = np.array([0.2, 0.9, 0.5, 0.4, 0.7, 0.35])
    total = np.zeros(6)
    for seed in range(4000):
        x, left = M.pivot(size, share, np.random.default_rng(seed))
        assert abs((x * size).sum() - (share * size).sum()) < 1e-6
        assert sum(0 < v < 1 for v in x) == (left >= 0)
        total += x
    assert np.abs(total / 4000 - share).max() < 0.03
