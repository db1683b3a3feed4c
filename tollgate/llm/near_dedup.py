r"""Near-duplicate groups by improved consistent weighted sampling (ICWS).

A document is the bag of its runs of five words (shingles), each weighed by its count times a
damped inverse document frequency, 1 + ln((1 + N) / (1 + df)) / (8 ln(2 + N)), between 1
and 1 + 1/8: the copies of a large group share shingles that are frequent for that very
reason, and a steeper weight would count them as unlike. Document frequencies are counted over all documents in a fixed number of hash buckets, so
that their table has the same size for any corpus; a shingle as common as a
boilerplate line stands out of its bucket, rare ones weigh alike. ICWS draws samples from a
bag such that two bags draw the same sample with a probability of their weighted Jaccard
similarity (sum of the lesser weights over sum of the greater). Samples are banded; documents that
share a band are candidates, verified on their whole texts.

Documents with the same bag are one class; candidates, verification and grouping work on
classes, so a group of exact copies costs one class, and buckets with the same classes in
several bands count once. First, every class of a bucket is verified against the bucket's
center, the class with the most company over its bands: a star, linear in the bucket,
which links what resembles the center. The rest is done exactly, not by a cap: in each bucket
whose classes are not all connected yet, the classes that some other, unconnected
class resembles by its samples (half of them agree) are compared each with each, by matrix
products over the shingles they share, in tiles of bounded size; a tile gives back
only links that connect something. Groups are the connected components of the links.

Defined results: a text without words (null and empty ones too) is grouped only with
texts that equal it; fewer than five words make one shingle. Rows are told apart by a row
number fixed in a checkpoint, so repeated rows and repeated or null ids keep their own
rows. Of a group the row of the largest id stays (null ids are smallest, then the
first read). Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import text_of, tidy, tidy_group
from tollgate.llm.words import WordHasher, chunks, mix, shingles
from tollgate.operators.joins import fits_broadcast
from tollgate.plans.materialize import materialize

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 10, 3
SAMPLES = BANDS * ROWS
AGREE = SAMPLES // 2  # at similarity 0.8, fewer than half of 30 samples agree in 1 of 10,000 cases
DF_BITS = 18
TILE = 2048  # classes that one task compares each with each
COLUMNS = 1024  # shingles of one matrix product


def bag(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles (sorted hashes) and their counts."""
    return np.unique(shingles(words, WORDS), return_counts=True)


def bags(texts: list[str], hasher: WordHasher) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The bag of each text, in order."""
    for a, b in chunks(texts):
        words, at = hasher(texts[a:b])
        for i in range(b - a):
            yield bag(words[at[i]:at[i + 1]])


def buckets_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - DF_BITS)).astype(np.int64)


def count_documents(docs: DataFrame, text_col: str) -> tuple[int, np.ndarray]:
    """(number of documents, documents per bucket of shingles). Every task adds up its
    own documents; the sums of all tasks are one table of fixed size (2 ** DF_BITS
    numbers), the only thing that reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total, n = WordHasher(), np.zeros(1 << DF_BITS, dtype=np.int64), 0
        for batch in batches:
            for hashes, _ in bags(batch.column(0).to_pylist(), hasher):
                n += 1
                np.add.at(total, buckets_of(hashes), 1)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(total[used], n))],
                                         names=["bucket", "n"])

    counted = docs.select(text_of(text_col).alias("t")).mapInArrow(tidy(run), "bucket bigint, n bigint")
    summed = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    bucket, n = (summed.column(c).to_numpy() for c in ("bucket", "n"))
    df = np.zeros(1 << DF_BITS, dtype=np.int64)
    df[bucket[bucket >= 0]] = n[bucket >= 0]
    return int(n[bucket < 0].sum()), df


def idf_table(n: int, df: np.ndarray) -> np.ndarray:
    """Weight factor per bucket, from 1 on; a bucket that overflows the corpus has 1."""
    return (1 + np.maximum(0, np.log((1 + n) / (1 + df))) / (8 * np.log(2 + n))).astype(np.float32)


class Sampler:
    """ICWS samples of weighted bags. The random variates of a shingle in a sample
    (r and c from Gamma(2, 1), b uniform) are read from tables of their quantiles at
    places its hash gives, so equal shingles get equal ones everywhere."""

    def __init__(self) -> None:
        def gamma_quantiles(n: int) -> np.ndarray:
            p = (np.arange(n) + 0.5) / n
            low, high = np.zeros(n), np.full(n, 64.0)
            for _ in range(60):  # bisection of 1 - exp(-x) (1 + x) = p
                mid = (low + high) / 2
                below = -np.expm1(-mid) - mid * np.exp(-mid) < p
                low, high = np.where(below, mid, low), np.where(below, high, mid)
            return mid

        self.r = gamma_quantiles(1 << 14).astype(np.float32)
        self.r_inverse = 1 / self.r
        self.b = ((np.arange(1 << 14) + 0.5) / (1 << 14)).astype(np.float32)
        self.log_c = np.log(gamma_quantiles(1 << 18)).astype(np.float32)
        self.seeds = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64))

    def __call__(self, hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Samples (bags x SAMPLES) of non-empty bags laid one after another, bag i from starts[i]."""
        log_w = np.log(weights).astype(np.float32)
        out = np.empty((len(starts), SAMPLES), dtype=np.uint32)
        for s in range(SAMPLES):
            u = hashes ^ self.seeds[s]
            u *= np.uint64(0xBF58476D1CE4E5B9)
            u ^= u >> np.uint64(31)
            u *= np.uint64(0x94D049BB133111EB)
            at = (u >> np.uint64(50)).astype(np.intp)
            r = self.r[at]
            b = self.b[((u >> np.uint64(36)) & np.uint64(0x3FFF)).astype(np.intp)]
            t = np.floor(log_w * self.r_inverse[at] + b)
            log_a = self.log_c[((u >> np.uint64(18)) & np.uint64(0x3FFFF)).astype(np.intp)] - r * (t - b + 1)
            # the least log_a of each bag, with what was drawn there: order-keeping bits of
            # the float above, a hash of the shingle and t below
            bits = log_a.view(np.uint32)
            ordered = np.where(bits >> 31, ~bits, bits | np.uint32(0x80000000)).astype(np.uint64)
            drawn = (u ^ (t.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) >> np.uint64(32)
            out[:, s] = np.minimum.reduceat((ordered << np.uint64(32)) | drawn, starts) & np.uint64(0xFFFFFFFF)
        return out


def class_of(hashes: np.ndarray, counts: np.ndarray, text: str) -> bytes:
    """128 bits that equal bags share; of the text where it has no words."""
    if len(hashes) == 0:
        return hashlib.blake2b(text.encode(), digest_size=16, key=b"text").digest()
    return hashlib.blake2b(hashes.tobytes() + counts.astype(np.int64).tobytes(), digest_size=16).digest()


def sign(docs: DataFrame, id_col: str, text_col: str, idf: np.ndarray) -> DataFrame:
    """row, id, text_key (64-bit hash of the text), class, weight, samples, bands."""
    sent = docs.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, sampler, table = WordHasher(), Sampler(), sent.value
        for batch in batches:
            texts = batch.column(3).to_pylist()
            classes, weight, samples = [], np.zeros(len(texts)), np.zeros((len(texts), SAMPLES), dtype=np.uint32)
            for a, b in chunks(texts):
                own, full = [], []
                for i, (hashes, counts) in enumerate(bags(texts[a:b], hasher)):
                    classes.append(class_of(hashes, counts, texts[a + i]))
                    if len(hashes):
                        full.append(a + i)
                        own.append((hashes, counts * table[buckets_of(hashes)]))
                if own:
                    starts = np.cumsum([0] + [len(h) for h, _ in own[:-1]])
                    samples[full] = sampler(np.concatenate([h for h, _ in own]), np.concatenate([w for _, w in own]), starts)
                    weight[full] = [w.sum() for _, w in own]
            grouped = samples.reshape(len(texts), BANDS, ROWS).astype(np.uint64)
            band = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(texts), BANDS)).copy()
            for j in range(ROWS):
                band = mix(band ^ grouped[:, :, j])
            some = weight > 0
            lists = [pa.array([list(x) if ok else [] for x, ok in zip(m.tolist(), some)], pa.list_(t))
                     for m, t in ((samples.view(np.int32), pa.int32()), (band.view(np.int64), pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(classes, pa.binary()), pa.array(weight), *lists],
                names=["row", id_col, "text_key", "class", "weight", "samples", "bands"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = text_of(text_col)
    return docs.select(F.monotonically_increasing_id().alias("row"), id_col, F.xxhash64(text).alias("text_key"),
                       text.alias("_text")).mapInArrow(tidy(run), f"row bigint, `{id_col}` {kind}, text_key bigint, "
                       "class binary, weight double, samples array<int>, bands array<bigint>")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> float:
    """Weighted Jaccard similarity of two bags (sorted distinct hashes, counts)."""
    wa, wb = a[1] * idf[buckets_of(a[0])], b[1] * idf[buckets_of(b[0])]
    _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(wa[ia], wb[ib]).sum()
    total = wa.sum() + wb.sum() - shared
    return float(shared / total) if total else 0.0


def verified(pairs: DataFrame, texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """The (a, b) of `pairs` whose texts reach THRESHOLD. `texts` has a text of each class;
    a pair's two texts are looked up by two joins and compared row by row."""
    sent = pairs.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = WordHasher(), sent.value
        for batch in batches:
            a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            ok = []
            for i, j in chunks([x + y for x, y in zip(a, b)]):
                known: dict[str, tuple] = {}
                distinct = list(dict.fromkeys([*a[i:j], *b[i:j]]))
                known.update(zip(distinct, bags(distinct, hasher)))
                ok += [similarity(known[x], known[y], table) >= THRESHOLD for x, y in zip(a[i:j], b[i:j])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])

    left = texts.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("class").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(tidy(run), "a binary, b binary, ok boolean")


def components(edges: DataFrame) -> DataFrame:
    """(class, root) of every class in `edges` (a, b): root is the same within a connected
    component. In each round every class takes the name of the first among itself and its
    neighbours, and the edges are renamed; an image of a connected graph is connected, so
    nothing falls apart. The order is by a hash that differs from round to round, so a round
    leaves a constant part of the classes on average and rounds grow with the logarithm of a
    component. One checkpoint a round: the edges, from which its renaming follows again."""
    def renaming(left: DataFrame, seed: int) -> DataFrame:
        def placed(c: str) -> Column:
            return F.struct(F.xxhash64(F.lit(seed), c).alias("h"), F.col(c).alias("to"))

        return left.union(left.select("b", "a")).groupBy("a").agg(F.min(placed("b")).alias("x")).select(
            "a", F.least("x", placed("a"))["to"].alias("to"))

    def renamed(frame: DataFrame, column: str, names: DataFrame) -> DataFrame:
        side = names.select(F.col("a").alias(column), F.col("to").alias("_to"))
        return frame.join(side, column, "left").withColumn(column, F.coalesce("_to", column)).drop("_to")

    left = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rounds = []
    while not left.isEmpty():
        rounds.append(renaming(left, len(rounds)))
        moved = renamed(renamed(left, "a", rounds[-1]), "b", rounds[-1]).where("a <> b")
        left = materialize(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels = edges.select(F.col("a").alias("class")).union(edges.select("b")).distinct().withColumn("root", F.col("class"))
    for names in rounds:
        labels = renamed(labels, "root", names)
    return materialize(labels)


def tiles(members: DataFrame) -> DataFrame:
    """`members` (band, n, class, ...) dealt to units of work: one unit for a bucket of up to
    TILE classes; a larger one is split by hash into tiles, with a unit for each pair of
    them, so that every two classes meet in some unit and no unit outgrows a task."""
    parts = F.ceil(F.col("n") / TILE).cast("int")
    mine = F.pmod(F.xxhash64("class"), parts).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), parts - 1), lambda j: F.struct(F.least(mine, j).alias("i"), F.greatest(mine, j).alias("j")))
    return members.withColumn("_p", F.explode(pairs)).withColumn("unit", F.xxhash64("band", "_p.i", "_p.j")).drop("_p")


def resembling(units: DataFrame) -> DataFrame:
    """(unit, class, root) of the classes of a unit that some class of another root in it
    resembles: at least AGREE samples agree."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        samples = np.array(frame["samples"].tolist(), dtype=np.int32)
        roots = np.unique(frame["root"], return_inverse=True)[1]
        like = np.zeros(len(frame), dtype=bool)
        for at in range(0, len(frame), 256):
            agree = np.zeros((min(256, len(frame) - at), len(frame)), dtype=np.uint8)
            for s in range(SAMPLES):
                agree += samples[at:at + 256, s, None] == samples[None, :, s]
            like[at:at + 256] = ((agree >= AGREE) & (roots[at:at + 256, None] != roots[None, :])).any(axis=1)
        return frame.loc[like, ["unit", "class", "root"]]

    return units.select("unit", "class", "root", "samples").groupBy("unit").applyInPandas(
        tidy_group(run), "unit bigint, class binary, root binary")


def shared_weight(own: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(total weight of each bag, weight that each two share): the sum of the lesser
    weights is a product of presence matrices over (shingle, how-many-eth occurrence)."""
    hashes = np.concatenate([np.repeat(h, c) for h, c in own])
    nth = np.concatenate([np.concatenate([np.arange(k) for k in c]) if len(c) and c.max() > 1 else np.zeros(len(c), dtype=np.int64)
                          for _, c in own])
    owner = np.repeat(np.arange(len(own)), [int(c.sum()) for _, c in own])
    weight = idf[buckets_of(hashes)].astype(np.float64)
    total = np.bincount(owner, weights=weight, minlength=len(own))
    items, at, times = np.unique(mix(hashes + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
    several = times[at] > 1  # the others are shared with nobody
    column = np.cumsum(times > 1) - 1
    owner, at, weight = owner[several], column[at[several]], weight[several]
    order = np.argsort(at, kind="stable")
    owner, at, weight = owner[order], at[order], weight[order]
    both = np.zeros((len(own), len(own)))
    for first in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
        a, b = np.searchsorted(at, [first, first + COLUMNS])
        m = np.zeros((len(own), COLUMNS))
        m[owner[a:b], at[a:b] - first] = np.sqrt(weight[a:b])
        both += m @ m.T
    return total, both


def links_within(units: DataFrame, idf: np.ndarray) -> DataFrame:
    """(a, b): the roots of linked classes of different roots in the same unit (unit, class, root,
    text), as many as connect all that is connected there."""
    sent = units.sparkSession.sparkContext.broadcast(idf)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        hasher = WordHasher()
        own = list(bags(frame["text"].tolist(), hasher))
        total, both = shared_weight(own, sent.value)
        names = frame["root"].tolist()
        group = np.unique(frame["root"], return_inverse=True)[1]
        out: list[tuple[bytes, bytes]] = []
        for i in range(len(names)):
            near = both[i] >= THRESHOLD * (total[i] + total - both[i]) - 1e-9
            while True:  # one link to each group that is not connected to i yet
                new = np.flatnonzero(near & (group != group[i]))
                if len(new) == 0:
                    break
                out.append((names[i], names[new[0]]))
                group[group == group[new[0]]] = group[i]
        return pd.DataFrame(out, columns=["a", "b"])

    return units.groupBy("unit").applyInPandas(tidy_group(run), "a binary, b binary")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: row, id, text_key, group (a class of the group), keep_id,
    group_size and kept."""
    n, df = count_documents(docs, text_col)
    idf = idf_table(n, df)
    signed = materialize(sign(docs, id_col, text_col, idf))
    classes = materialize(signed.groupBy("class").agg(
        F.max_by(F.struct("text_key", "weight", "samples", "bands"), "row").alias("x")).select("class", "x.*"))
    placed = classes.select("class", F.explode("bands").alias("band"))
    # buckets of more than one class; of those with the same classes, one
    buckets = materialize(placed.groupBy("band").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("class")).alias("who")).where("n > 1"))
    company = placed.join(buckets, "band").groupBy("class").agg(F.sum("n").alias("company"))
    once = buckets.groupBy("n", "who").agg(F.min("band").alias("band")).select("band", "n")
    members = materialize(placed.join(once, "band").join(company, "class"))
    centers = materialize(members.groupBy("band").agg(F.max(F.struct("company", "class")).alias("x")).select(
        "band", F.col("x.class").alias("center")))
    stars = materialize(members.join(centers, "band").where("class <> center").select(
        F.col("class").alias("a"), F.col("center").alias("b")).distinct())
    texts = class_texts(docs, text_col, classes, members)
    links = materialize(verified(stars, texts, idf)).where("ok").select("a", "b")
    roots = components(links)
    # the rest: buckets with several roots left
    rooted = materialize(members.select("band", "n", "class").join(roots, "class", "left").withColumn(
        "root", F.coalesce("root", "class")))
    open_buckets = rooted.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("band")
    units = tiles(rooted.join(open_buckets, "band").join(classes.select("class", "samples"), "class"))
    rest = materialize(resembling(units))
    more = materialize(links_within(rest.join(texts, "class"), idf))
    joined = components(more).select(F.col("class").alias("root"), F.col("root").alias("final"))
    named = signed.select("row", id_col, "text_key", "class").join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
    grouped = materialize(named.join(joined, "root", "left").select(
        "row", id_col, "text_key", F.coalesce("final", "root").alias("group")))
    # on its own, so that the join can split a large group
    keep = materialize(grouped.groupBy("group").agg(
        F.max(F.struct(F.col(id_col).alias("id"), (-F.col("row")).alias("first"))).alias("keep"), F.count("*").alias("group_size")))
    return grouped.join(keep, "group").select(
        "row", id_col, "text_key", "group", F.col("keep.id").alias("keep_id"), "group_size",
        (F.col("row") == -F.col("keep.first")).alias("kept"))


def class_texts(docs: DataFrame, text_col: str, classes: DataFrame, members: DataFrame) -> DataFrame:
    """(class, text) of the classes in `members`, one text each, found by the text's hash.
    The hashes are broadcast where their checked number allows it, so that other texts
    do not move; else the texts are shuffled by their hash."""
    wanted = materialize(members.select("class").distinct().join(classes.select("class", "text_key"), "class"))
    n = wanted.count()
    keys = F.broadcast(wanted) if fits_broadcast(n, 64) else wanted
    text = text_of(text_col)
    found = docs.select(F.xxhash64(text).alias("text_key"), text.alias("text")).join(keys, "text_key")
    return materialize(found.groupBy("class").agg(F.first("text").alias("text")))
