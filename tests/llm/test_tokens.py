"""Collocations, token files and whitening: brute force, file layout, spectra, edge cases."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.conftest import SF, words
from tollgate.llm import collocations as C
from tollgate.llm import token_files as T
from tollgate.llm import whitening as W
from tollgate.llm.queries import LLM_QUERIES

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


# ---- collocations ---------------------------------------------------------------

def brute_phrases(rows, min_count, percent=50, top=2000):
    """rows of (lang, text)."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i:i + k])] += 1
    out = set()
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        longer = Counter()
        for p, a in cand.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    longer[q] = max(longer[q], a)
        kept = []
        for p, a in cand.items():
            if len(p) == 2 and 100 * longer[p] >= percent * a:
                continue
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.add((lang, rank, p.decode(), -a, l, r, totals[lang], -s))
    return out


def found(df):
    return {tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


def test_phrases_match_brute_force_in_many_groups(spark, documents, document_rows):
    """A small budget: many groups, and words so frequent that pairs and triples are split."""
    rows = [(r[2], r[1]) for r in document_rows]
    got = C.phrases(documents, min_count=4, budget=300, top=500)
    assert found(got) == brute_phrases(rows, 4, top=500)


def test_groups_hold_their_budget(spark, documents):
    texts = C._texts(documents, "lang", "text")
    counted = C.word_counts(texts, 0).where("n >= 10").cache()
    plan = C.plan_groups(counted, 2000)
    load = Counter()
    for r in counted.where("n <= 2000").collect():
        load[plan.of_cell[(r.h & (1 << 64) - 1) >> 64 - C.CELLS]] += r.n
    one_cell = max(Counter((r.h & (1 << 64) - 1) >> 64 - C.CELLS for r in counted.collect()).values()) * 2000
    assert max(load.values()) <= max(2000, one_cell) and len(load) == plan.n_cell
    assert {h for h in plan.hot.view(np.int64)} == {r.h for r in counted.where("n > 2000").collect()}


def test_phrases_edge_cases(spark, edge, none):
    assert C.phrases(none).isEmpty()
    rows = [(r.lang, r.text) for r in edge.collect()]
    assert found(C.phrases(edge, min_count=2)) == brute_phrases(rows, 2)


def test_phrases_take_pieces_ties_and_odd_characters(spark):
    texts = ["a b c. a b c, A B\tC;x\x0by\x0cz", "É b É b É b", "ıI İi K k", "a b" * 3, "\x00 \x00 \x00", "p\xa0q p\xa0q p\xa0q r",
             "w" * 500 + " " + "v" * 70000 + " w w", None, "", " . ", "a b:c d:a b:c d"] * 3
    rows = [(None if i % 5 == 4 else "x" if i % 2 else "und", t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert found(C.phrases(docs, min_count=3)) == brute_phrases(rows, 3)


def test_phrases_when_a_third_of_all_words_is_one(spark):
    rows = [("en", " ".join(["the", "of"] * 40 + words(i, 20).split())) for i in range(60)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(7)
    assert found(C.phrases(docs, budget=100)) == brute_phrases(rows, 10)


def test_colliding_words_are_hashed_anew(spark, monkeypatch):
    """A hash of which only 16 bits are left: words collide, which must be noticed."""
    docs = spark.createDataFrame([("en", words(7, 5000))], "lang string, text string")
    plain = C.mix
    monkeypatch.setattr(C, "mix", lambda x: plain(x) & np.uint64(0xFFFF))
    with pytest.raises(ValueError, match="same hash"):
        C.phrases(docs)


# ---- token files -------------------------------------------------------------------

def brute_tokens(rows, tokenizer):
    start, out = 0, Counter()
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, T.END_ID]
        out[(i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))] += 1
        start += len(ids)
    return out


def test_token_files_match_the_library(spark, document_rows):
    got = Counter(map(tuple, LLM_QUERIES["op12_token_files"](spark, SF).select(
        "doc_id", "start", "n_tokens", "ids_crc32").collect()))
    rows = sorted((r[0], r[1]) for r in document_rows)
    assert got == brute_tokens(rows, Tokenizer.from_file(VOCABULARY))


def test_pieces_encode_like_whole_texts():
    model, encoder = Tokenizer.from_file(VOCABULARY), None
    with open(VOCABULARY, encoding="utf-8") as f:
        encoder = T.PieceEncoder(f.read())
    texts = ["", " ", "a", " a  b ", "it's I'll'd 'T", "é ́a á", "x\x1cy\x85z w　v", "\x01 \x01a\x01 b", "12 345",
             "ΑΣ ΣΑΣ", "İstanbul İ", "<|endoftext|> a<|startoftext|>b", "ﬁ ﬁ 각", "\U0001F600 世界", "a\r\nb\tc",
             "w" * 5000, words(3, 4000), "\x00 a \x00", "‍ x️",
             "Word. WORD, word;word: Été!? ÉTÉ... été", "K Å ñ ǅ ǆ ﬀ", "can't Can'T. l'été", "ª º ß ẞ"]
    assert encoder.by_piece
    want = [np.array(model.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    assert encoder(texts) == want
    assert encoder(texts) == want  # from the cache
    assert [encoder([t])[0] for t in texts] == want


def test_signs_at_a_words_end_are_pieces_of_their_own():
    with open(VOCABULARY, encoding="utf-8") as f:
        vocabulary = f.read()
    encoder = T.PieceEncoder(vocabulary)
    encoder(["word. word, word; word\nword!", "word? word"])
    assert set(encoder.cache) == {"", "word", *".,;!?"}  # the word is learned and kept once
    texts = ["a. . b", "5. 6, x", "it's. he'S, x'. y", '"a". b', "a.. b... c.!", "_. a_. b", "x\x1c. a", "\u0130. x\u0130.", "\u00bd. \u00d7. \u00f7, \u00aa.",
             "\u0149. \u01c0, \u024f; \u0250.", "e\u0301. \u0301. a.\u0301", "<|endoftext|>. a<|endoftext|>b.", ".", ". a .", "a.\n.b.\t.", "a.\u00a0b. c.\r"]
    texts += ["w$ord &co, a--b (x) [Y]_{z}... \u00c9t\u00e9*; <|ENDOFTEXT|> <|endoftext|>x$ $<|startoftext|>", "a'b$c o'$ '$ 5$a", "-\u0130-a \u0250$x \u00d7$a"]
    texts += ["b" + chr(c) + "A" for c in range(0x260)] + ["$" + chr(c) for c in range(0x260)]
    texts += [chr(c) + s + e for c in range(0x260) for s in (".", "?") for e in ("", " x")]
    want = [np.array(x.ids, dtype="<u4").tobytes() for x in Tokenizer.from_str(vocabulary).encode_batch(texts, add_special_tokens=False)]
    assert encoder(texts) == want
    assert [encoder([t])[0] for t in texts[:40]] == want[:40] and encoder([]) == []
    other = Tokenizer.from_str(vocabulary)
    other.add_special_tokens(["stop."])  # a sign that belongs to a special token stays with it
    assert T.PieceEncoder(other.to_str())(["a stop. b."])[0] == np.array(
        other.encode("a stop. b.", add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_spans_keep_every_row():
    for sizes in ([], [5], [0, 0, 0], [9, 1, 1, 1, 12, 0, 3, 3]):
        got = list(T.spans(np.array(sizes, dtype=np.int32), 4))
        assert [i for a, b in got for i in range(a, b)] == list(range(len(sizes)))
        assert all(b - a == 1 or sum(sizes[a:b]) <= 4 for a, b in got)


def test_other_vocabularies_are_encoded_text_by_text():
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        encoder = T.PieceEncoder(f.read())
    texts = ["a b  c", " lead", "", "Word. word"]
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert not encoder.by_piece and [np.frombuffer(x, dtype="<u4").tolist() for x in encoder(texts)] == want


def test_token_file_layout(spark, documents, tmp_path):
    T.write_tokens(documents, str(tmp_path), VOCABULARY, n_files=3)
    files = sorted((tmp_path / "tokens").glob("*.parquet"))
    assert len(files) == 3
    for f in files:
        group = pq.ParquetFile(f).metadata.row_group(0)
        columns = {group.column(i).path_in_schema.split(".")[0]: group.column(i) for i in range(group.num_columns)}
        assert "RLE_DICTIONARY" in columns["ids"].encodings
        for name in ("doc_id", "n_tokens", "at"):
            assert "DELTA_BINARY_PACKED" in columns[name].encodings and "RLE_DICTIONARY" not in columns[name].encodings
        assert all(c.has_offset_index and c.compression == "ZSTD" for c in columns.values())
        assert columns["doc_id"].has_column_index
    whole = T.read_tokens(spark, str(tmp_path))
    ids = [r.doc_id for r in whole.orderBy("start").select("doc_id").collect()]
    assert ids == sorted(ids) and len(ids) == documents.count()
    one = T.stored(spark, str(tmp_path)).where("doc_id between 100 and 110").select("doc_id", "n_tokens")
    plan = one._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,100)" in plan and "ids" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_token_files_edge_cases(spark, edge, none):
    assert T.encode_to_files(none, VOCABULARY).isEmpty()
    got = T.ids_checksum(T.encode_to_files(edge, VOCABULARY), ["doc_id", "start", "n_tokens"]).collect()
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert len(got) == len(rows)
    model = Tokenizer.from_file(VOCABULARY)
    sums = Counter((i, n, c) for i, _, n, c in brute_tokens(rows, model).elements())
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sums
    ordered = sorted(got, key=lambda r: r.start)
    key = [(-math.inf if r.doc_id is None else r.doc_id) for r in ordered]
    assert key == sorted(key)
    assert [r.start for r in ordered] == [sum(r.n_tokens for r in ordered[:i]) for i in range(len(ordered))]


def test_rows_of_one_id_and_text_are_dealt_over_files(spark, tmp_path):
    docs = spark.range(0, 4000, 1, 4).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("same text").alias("text"))
    T.write_tokens(docs, str(tmp_path), VOCABULARY, n_files=4)
    sizes = [r["count"] for r in T.stored(spark, str(tmp_path)).groupBy("part").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000 and sum(sizes) == 4000


# ---- whitening -----------------------------------------------------------------------

def brute_whitening(vectors):
    x = np.floor(np.array(vectors, dtype=np.float64) * 1024) + 100000
    y = x - x.mean(axis=0)
    v = y.T @ y / len(x)
    e, q = np.linalg.eigh(v)
    return x, e[::-1], q[:, ::-1], np.trace(v)


def test_whitening_matches_eigh(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    x, e, q, trace = brute_whitening([r.embedding for r in rows])
    n, sums = len(x), [int(s) for s in x.sum(axis=0)]
    white = (x - x.mean(axis=0)) @ q[:, :8] / np.sqrt(e[:8])
    at = {r.vec_id: i for i, r in enumerate(rows)}
    got = LLM_QUERIES["op13_whitening"](spark, SF).collect()
    assert len(got) == 8 * n
    sign = {}
    for r in got:
        i, k = at[r.vec_id], r.component - 1
        sign.setdefault(k, np.sign(r.whitened) * np.sign(white[i, k]))
        assert abs(sign[k] * r.whitened - white[i, k]) < 1e-6
        assert r.n == n and abs(r.explained - e[k] / trace) < 1e-9 and r.identity_error < 1e-9 and r.certified
        assert r.deviation == sum((n * int(a) - s) ** 2 for a, s in zip(x[i], sums))


def spectra():
    r = np.random.default_rng(3)
    q = np.linalg.qr(r.normal(size=(12, 12)))[0]
    yield "distinct", q @ np.diag(np.arange(12, 0, -1.0)) @ q.T
    yield "close", q @ np.diag([5, 5 - 1e-9, 5 - 2e-9, 3, 3, 3, 2, 1, 1, .5, 1e-3, 1e-6]) @ q.T
    yield "multiple", np.eye(12) * 7
    yield "low rank", q[:, :3] @ np.diag([9.0, 4, 1]) @ q[:, :3].T
    yield "steep", q @ np.diag(10.0 ** -np.arange(12)) @ q.T
    yield "blocks", np.kron(np.eye(6), [[1.0, 2.0], [2.0, 1.0]])
    yield "huge", 1e12 * (q @ np.diag(np.arange(12, 0, -1.0)) @ q.T)
    yield "one", np.array([[3.0]])
    yield "zero", np.zeros((5, 5))


@pytest.mark.parametrize("name,matrix", list(spectra()), ids=lambda x: x if isinstance(x, str) else "")
def test_spectrum_slicing(name, matrix):
    matrix = (matrix + matrix.T) / 2
    want = np.sort(np.linalg.eigvalsh(matrix))[::-1]
    scale = np.abs(matrix).sum(axis=1).max()
    want = want[want > 8 * len(matrix) * W.EPS * scale][:8] if scale else want[:0]
    got = W.leading_spectrum(matrix)
    assert len(got.values) == len(want) and np.allclose(got.values, want, rtol=0, atol=1e-13 * max(scale, 1e-300) * 10)
    v = got.vectors
    assert np.allclose(v.T @ v, np.eye(len(want)), atol=1e-10)
    assert np.allclose(matrix @ v, v * got.values, atol=1e-11 * max(scale, 1))
    if name in ("distinct", "steep", "low rank", "huge", "one"):
        assert all(got.certified)


def test_inertia_counts():
    r = np.random.default_rng(5)
    for size in (1, 2, 5, 20):
        m = r.normal(size=(size, size))
        m = m + m.T
        e = np.linalg.eigvalsh(m)
        for t in r.normal(size=20) * 3:
            assert W.eigenvalues_above(m, t) == (e > t).sum()


def vectors(spark, rows, kind="array<float>"):
    return spark.createDataFrame(rows, f"vec_id bigint, embedding {kind}, component string, n string, whitened string")


def test_whitening_edge_cases(spark):
    r = np.random.default_rng(1)
    good = [(i, [float(c) for c in r.normal(size=4)], "x", None, "y") for i in range(30)]
    bad = [(100, None, None, None, None), (101, [1.0, None, 2.0, 3.0], "", "", ""), (102, [1.0, math.nan, 0.0, 0.0], "", "", ""),
           (103, [math.inf, 0.0, 0.0, 0.0], "", "", ""), (104, [], "", "", ""), (105, [1.0, 2.0], "", "", ""), (106, [3e38] * 4, "", "", "")]
    twice = [good[0], (None, good[1][1], None, None, None)]
    df = vectors(spark, good + bad + twice).repartition(5)
    got = W.whiten(df, W.fit(df)).collect()
    assert Counter(x.vec_id for x in got) == Counter({**{i: 4 for i in range(1, 30)}, 0: 8, None: 4})
    assert max(x.identity_error for x in got) < 1e-9 and got[0].n == 32
    assert abs(sum({x.component: x.explained for x in got}.values()) - 1) < 1e-12
    for rows in ([], bad[:5], [good[0]] * 3):  # none, none sound, all alike
        empty = vectors(spark, rows)
        assert W.whiten(empty, W.fit(empty)).isEmpty()


def test_whitening_of_large_and_offset_entries_is_exact(spark):
    """Far entries beside tiny spreads: what an uncentred sum of products would lose."""
    r = np.random.default_rng(2)
    rows = [(i, [1e9 + float(a), float(b), 2.0 ** 40], None, None, None) for i, (a, b) in enumerate(r.normal(size=(200, 2)))]
    df = vectors(spark, rows, "array<double>").repartition(3)
    got = W.whiten(df, W.fit(df)).collect()
    x = [[int(math.floor(c * 1024)) + 100000 for c in row[1]] for row in rows]
    sums = [sum(c) for c in zip(*x)]
    want = [sum((200 * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    assert {(g.vec_id, g.deviation) for g in got} == set(enumerate(want)) and max(g.component for g in got) == 2
    assert got[0].identity_error < 1e-9
    wide = vectors(spark, [(i, [2.0 ** 42 * (i % 2), float(i)], None, None, None) for i in range(6)], "array<double>")
    assert {g.deviation for g in W.whiten(wide, W.fit(wide)).collect()} == {None}
