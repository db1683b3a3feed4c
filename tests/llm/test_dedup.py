"""Exact and near dedup against brute force."""

import hashlib
import itertools
import string
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from llm.conftest import SF, edge_rows, words
from tollgate.llm import near_dedup as N
from tollgate.llm.exact_dedup import exact_dedup
from tollgate.llm.queries import LLM_QUERIES
from tollgate.llm.words import WordHasher

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def exact_reference(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=repr)


def check_exact(df, rows):
    got = df.collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == exact_reference(rows)
    kept = defaultdict(int)
    for r in got:
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) <= {1}


def test_exact_on_documents(spark, document_rows):
    check_exact(LLM_QUERIES["op6_exact_dedup"](spark, SF), [r[:2] for r in document_rows])


@pytest.mark.parametrize("options", [
    {}, {"block_chars": 3}, {"block_chars": 7, "block_hash": lambda c: F.pmod(F.xxhash64(c), F.lit(5))},
    {"block_chars": 1024, "block_hash": lambda c: F.lit(1).cast("bigint") + F.length(c) * 0}])
def test_exact_edge_cases(edge, options):
    """Small blocks make many levels; weak hashes make every block collide."""
    rows = edge_rows()
    if "block_hash" in options or options.get("block_chars") == 3:
        edge = edge.where(F.coalesce(F.length("text"), F.lit(0)) < 10_000)
        rows = [r for r in rows if len(r[1] or "") < 10_000]
    check_exact(exact_dedup(edge, **options), [r[:2] for r in rows])


def test_exact_empty(none):
    assert exact_dedup(none).count() == 0


def plain_bags(texts, idf):
    hasher = WordHasher()
    return [(h, c, c * idf[N.buckets_of(h)]) for h, c in N.bags(texts, hasher)]


def weighted_jaccard(a, b):
    wa, wb = dict(zip(a[0].tolist(), a[2].tolist())), dict(zip(b[0].tolist(), b[2].tolist()))
    low = sum(min(w, wb.get(k, 0.0)) for k, w in wa.items())
    high = sum(wa.values()) + sum(wb.values()) - low
    return low / high if high else 0.0


def near_reference(texts, idf):
    """Components over all pairs that share a shingle and reach the threshold; texts
    without words join those that equal them."""
    bags = plain_bags(texts, idf)
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    met, by_shingle, by_text = set(), defaultdict(list), defaultdict(list)
    for i, b in enumerate(bags):
        if len(b[0]) == 0:
            by_text[texts[i]].append(i)
        for s in b[0].tolist():
            by_shingle[s].append(i)
    for same in by_shingle.values():
        met.update(itertools.combinations(same, 2))
    edges = [(i, j) for i, j in met if weighted_jaccard(bags[i], bags[j]) >= N.THRESHOLD]
    edges += [(g[0], x) for g in by_text.values() for x in g[1:]]
    for i, j in edges:
        parent[find(i)] = find(j)
    return [find(i) for i in range(len(texts))]


def partition(labels):
    groups = defaultdict(list)
    for i, g in enumerate(labels):
        groups[g].append(i)
    return sorted(groups.values())


def test_near_on_documents(spark, documents, document_rows):
    n, df = N.count_documents(documents, "text")
    assert n == len(document_rows)
    ids = {r[0]: k for k, r in enumerate(document_rows)}
    labels = near_reference([r[1] or "" for r in document_rows], N.idf_table(n, df))
    got = LLM_QUERIES["op7_near_dedup"](spark, SF).collect()
    found = [None] * len(ids)
    for r in got:
        found[ids[r.doc_id]] = r.class_id
        assert r.kept == (r.doc_id == r.class_id)
    assert partition(found) == partition(labels)
    sizes = defaultdict(int)
    for r in got:
        sizes[r.class_id] += 1
    assert all(r.group_size == sizes[r.class_id] for r in got)


def test_near_edge_cases(edge):
    got = N.near_groups(edge).collect()
    assert len(got) == len(edge_rows())
    by = defaultdict(set)
    for r in got:
        by[r.group].add(r.doc_id)
    groups = {frozenset(x) for x in by.values()}
    assert frozenset({4, 5, 6}) in groups and frozenset({-5, 20}) in groups and frozenset({10, 11}) in groups
    assert frozenset({9007199254740992, 9007199254740993}) in groups
    assert sum(r.kept for r in got) == len(by)


def test_near_empty(none):
    assert N.near_groups(none).count() == 0


def test_near_chain_and_hot_group(spark):
    """A large group of near copies is one group; documents that share only a hot passage are not."""
    base, passage = words(10, 120).split(), words(11, 20)
    rows = []
    for i in range(300):
        w = list(base)
        w[(i * 7) % 120] = f"edit{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, words(100 + i, 60) + " " + passage) for i in range(300)]
    got = N.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    near = {r.doc_id: r.keep_id for r in got}
    assert {near[i] for i in range(300)} == {299}
    assert all(near[1000 + i] == 1000 + i for i in range(300))


def test_shared_weight_matches_similarity():
    import numpy as np

    rng = np.random.default_rng(5)
    vocabulary = words(3, 40).split()
    texts = [" ".join(rng.choice(vocabulary[:10 + 3 * i], size=rng.integers(3, 60))) for i in range(10)] * 2 + ["a b", "a b c d e a b c d e"]
    own = list(N.bags(texts, WordHasher()))
    idf = rng.uniform(1, 2, 1 << N.DF_BITS)
    total, both = N.shared_weight(own, idf)
    for i, x in enumerate(own):
        for j, y in enumerate(own):
            if i == j:  # what a bag has to itself alone is not counted
                continue
            assert abs(both[i, j] / (total[i] + total[j] - both[i, j]) - N.similarity(x, y, idf)) < 1e-9


@pytest.mark.parametrize("tile", [2048, 7])
def test_near_chain_is_followed_beyond_the_center(spark, tile, monkeypatch):
    """Each text is near the next one only, so one star cannot connect them; also in small tiles."""
    monkeypatch.setattr(N, "TILE", tile)
    base, rows = words(20, 200).split(), []
    for i in range(40):
        base[(i * 31) % 200] = f"step{i}"
        rows.append((i, " ".join(base)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    n, counts = N.count_documents(df, "text")
    labels = near_reference([t for _, t in rows], N.idf_table(n, counts))
    got = {r.doc_id: r.group for r in N.near_groups(df).collect()}
    assert partition([bytes(got[i]) for i in range(40)]) == partition(labels) and len(set(labels)) == 1


def test_components_of_a_long_chain(spark):
    chain = [(bytes([i]), bytes([i + 1])) for i in range(60)] + [(b"\xf0", b"\xf1")]
    got = {bytes(r["class"]): bytes(r["root"]) for r in N.components(spark.createDataFrame(chain, "a binary, b binary")).collect()}
    (root,), other = {got[bytes([i])] for i in range(61)}, {got[b"\xf0"], got[b"\xf1"]}
    assert root in got and got[root] == root and len(other) == 1 and other < {b"\xf0", b"\xf1"}


def test_components_are_the_same_groups_as_union_find(spark):
    import random

    r = random.Random(4)
    edges = [(b"%03d" % r.randrange(300), b"%03d" % r.randrange(300)) for _ in range(220)] + [(b"000", b"%03d" % i) for i in range(40)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    got = {bytes(x["class"]): bytes(x["root"]) for x in N.components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    assert got.keys() == parent.keys()
    assert partition([got[x] for x in sorted(got)]) == partition([find(x) for x in sorted(got)])
    assert N.components(spark.createDataFrame([], "a binary, b binary")).isEmpty()


def test_samples_estimate_weighted_jaccard():
    import numpy as np

    sampler, rng = N.Sampler(), np.random.default_rng(3)
    hits = []
    for _ in range(200):
        pool = rng.integers(1, 1 << 63, size=300).astype(np.uint64)
        wa, wb = rng.uniform(0.5, 3, 300), rng.uniform(0.5, 3, 300)
        want = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
        s = sampler(np.concatenate([pool, pool]), np.concatenate([wa, wb]), np.array([0, 300]))
        hits.append((s[0] == s[1]).mean() - want)
    assert abs(np.mean(hits)) < 0.02
