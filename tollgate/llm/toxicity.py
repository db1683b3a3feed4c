r"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

Features are words and beginnings of words (hashed) that occur in a larger part of the
graded toxic documents than of the others; a document's value for one that it has is 1 + ln(1 +
100 * count / words). One weight per feature is shared by all thresholds: P(grade <= k) = 1 / (1 + exp(w.x - theta_k)) with
theta_0 < theta_1 < ... The output is the probability of each grade, their mean (the
expected severity), and whether grade 1 or more is likelier than grade 0.

Defined results: null texts and texts without words have no features, so they get the
grade that a text without any toxic word has. Without graded rows of two grades at least,
nothing is learned and every document has severity 0. Rows with a null grade are not
learned from. Equal texts get equal results; repeated rows keep their own rows. Only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import hash_fraction, text_of, tidy
from tollgate.llm.words import WordHasher, chunks
from tollgate.operators.joins import fits_broadcast
from tollgate.plans.materialize import materialize

BITS = 20
PREFIXES = (4, 6)  # bytes of a word's beginning that are features besides the word
FIT_TASKS = 12


def word_counts(texts: list[str], hasher: WordHasher) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(distinct buckets of words and beginnings, counts, number of words) of each text."""
    for a, b in chunks(texts):
        kinds, at = hasher.with_prefixes(texts[a:b], PREFIXES)
        cells = [(h >> np.uint64(64 - BITS)).astype(np.int64) for h in kinds]
        for i in range(b - a):
            own = np.concatenate([c[at[i]:at[i + 1]] for c in cells])
            yield *np.unique(own, return_counts=True), int(at[i + 1] - at[i])


def values(counts: np.ndarray, n: int) -> np.ndarray:
    return 1 + np.log1p(100.0 * counts / n)


class Model:
    """Words (sorted buckets), weights, and increasing thresholds. Tasks get the three arrays
    and make their own, since a worker may not have this package."""

    def __init__(self, cells: np.ndarray, weights: np.ndarray, thresholds: np.ndarray) -> None:
        self.cells, self.weights, self.thresholds = cells, weights, thresholds

    def features(self, cells: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(feature numbers, values) of the words that are features."""
        if len(self.cells) == 0 or n == 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0)
        at = np.minimum(np.searchsorted(self.cells, cells), len(self.cells) - 1)
        known = self.cells[at] == cells
        return at[known], values(counts[known], n)

    def grades(self, score: np.ndarray) -> np.ndarray:
        """Probability of each grade (rows: scores)."""
        below = 1 / (1 + np.exp(np.clip(score[:, None] - self.thresholds[None, :], -50, 50)))
        edges = np.hstack([np.zeros((len(score), 1)), below, np.ones((len(score), 1))])
        return np.diff(edges, axis=1)


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, grade: np.ndarray, weight: np.ndarray,
                n_features: int, ridge: float = 2e-4, steps: int = 600, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that minimise the weighted negative log likelihood plus
    ridge / 2 * |w|^2, by Adam. Thresholds are a first one and positive gaps."""
    k = int(grade.max())
    share = np.array([weight[grade <= g].sum() for g in range(k)]) / weight.sum()
    start = np.log(share / (1 - share))
    param = np.concatenate([np.zeros(n_features), [start[0]], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v = np.zeros_like(param), np.zeros_like(param)
    total = weight.sum()

    def unpack(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return p[:n_features], p[n_features] + np.concatenate([[0.0], np.cumsum(np.exp(p[n_features + 1:]))])

    for step in range(1, steps + 1):
        w, theta = unpack(param)
        score = np.bincount(rows, weights=vals * w[cols], minlength=len(grade))
        cut = np.concatenate([[-np.inf], theta, [np.inf]])
        with np.errstate(over="ignore"):
            high = 1 / (1 + np.exp(score - cut[grade + 1]))
            low = 1 / (1 + np.exp(score - cut[grade]))
        p = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / p, low * (1 - low) / p
        d_score = weight * (d_high - d_low) / total
        g_theta = np.zeros(k)
        np.add.at(g_theta, grade[grade < k], -(weight * d_high / total)[grade < k])
        np.add.at(g_theta, grade[grade > 0] - 1, (weight * d_low / total)[grade > 0])
        tail = np.cumsum(g_theta[::-1])[::-1]
        grad = np.concatenate([np.bincount(cols, weights=vals * d_score[rows], minlength=n_features) + ridge * w,
                               [tail[0]], tail[1:] * np.exp(param[n_features + 1:])])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        param = param - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return unpack(param)


def associated_words(graded: DataFrame, min_documents: int, min_ratio: float, max_features: int) -> np.ndarray:
    """Buckets of words that at least `min_documents` documents of grade 1 or more have, in a
    share of them `min_ratio` times that of the documents of grade 0; the most frequent
    `max_features` (the model's size). `graded` is the bounded training sample."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        seen, n = np.zeros((2, 1 << BITS), dtype=np.int32), np.zeros(2, dtype=np.int64)
        for batch in batches:
            toxic = [int(g > 0) for g in batch.column(1).to_pylist()]
            for side, (cells, _, _) in zip(toxic, word_counts(batch.column(0).to_pylist(), hasher)):
                seen[side, cells] += 1
                n[side] += 1
        used = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(seen[0, used], n[0]).astype(np.int64)),
             pa.array(np.append(seen[1, used], n[1]).astype(np.int64))], names=["cell", "clean", "toxic"])

    summed = graded.mapInArrow(tidy(run), "cell bigint, clean bigint, toxic bigint").groupBy("cell").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    total = summed.where("cell < 0").first()
    if total is None or not total["clean"] or not total["toxic"]:
        return np.zeros(0, dtype=np.int64)
    ratio = (F.col("toxic") / total["toxic"]) / ((F.col("clean") + 0.5) / total["clean"])
    kept = (summed.where((F.col("cell") >= 0) & (F.col("toxic") >= min_documents) & (ratio >= min_ratio))
            .orderBy(F.desc("toxic"), "cell").limit(max_features).select("cell").collect())
    return np.sort(np.array([r["cell"] for r in kept], dtype=np.int64))


def training_rows(sample: DataFrame, cells: np.ndarray) -> tuple[np.ndarray, ...]:
    """(rows, feature numbers, values, grades, weights) of the bounded sample; at most
    the number of features for each row reaches the driver."""
    sent = sample.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, model = WordHasher(), Model(sent.value, np.zeros(0), np.zeros(0))
        for batch in batches:
            found = [model.features(*x) for x in word_counts(batch.column(0).to_pylist(), hasher)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([f.tolist() for f, _ in found], pa.list_(pa.int64())),
                 pa.array([v.tolist() for _, v in found], pa.list_(pa.float64()))], names=["grade", "f", "v"])

    # equal rows are merged: most clean documents have no feature at all
    merged = (sample.mapInArrow(tidy(run), "grade int, f array<bigint>, v array<double>")
              .groupBy("grade", "f", "v").count().orderBy("grade", "f", "v").collect())
    sizes = [len(r["f"]) for r in merged]
    rows = np.repeat(np.arange(len(merged)), sizes)
    cols = np.array([i for r in merged for i in r["f"]], dtype=np.int64)
    vals = np.array([x for r in merged for x in r["v"]], dtype=np.float64)
    return (rows, cols, vals, np.array([r["grade"] for r in merged], dtype=np.int64),
            np.array([r["count"] for r in merged], dtype=np.float64))


def label_bounds(counts: dict[int, int], max_rows: int) -> dict[int, int]:
    """How many rows of each label may be drawn: labels with few rows give all of them and
    the others share the rest of `max_rows` alike."""
    out, left = {}, max_rows
    for i, label in enumerate(sorted(counts, key=lambda x: (counts[x], x))):
        out[label] = min(counts[label], left // (len(counts) - i))
        left -= out[label]
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, label_col: str, text_col: str = "text",
                    max_rows: int = 40_000, seed: int = 5) -> DataFrame:
    """(text, label) of about `max_rows` labelled documents, drawn by a hash of the id from
    all labels that are not null, a bounded number of each label (see `label_bounds`), so
    a rare label is not left out in a large table; the documented bound of what is learned
    from. The drawn labels are broadcast (their number is checked), so no text is
    shuffled but the sample's own, which is written once."""
    told = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(
        id_col, F.col(label_col).cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in told.groupBy("label").count().collect()}  # a row per label
    bounds = label_bounds(counts, max_rows)
    share = F.coalesce(*[F.when(F.col("label") == k, n / counts[k]) for k, n in bounds.items()], F.lit(0.0))
    drawn = materialize(told.where(hash_fraction(id_col, seed=seed) < share))
    if fits_broadcast(drawn.count()):
        drawn = F.broadcast(drawn)
    texts = docs.select(id_col, text_of(text_col).alias("text")).join(drawn, id_col)
    return materialize(texts.select("text", "label").repartition(FIT_TASKS))


def density_grades(sample: DataFrame, levels: int = 2, min_documents: int = 3, min_ratio: float = 30.0,
                   max_features: int = 4096) -> DataFrame:
    """(text, grade) of a sample (text, label) whose labels only say toxic (1) or not (0).
    Toxic documents are graded 1 to `levels` by quantiles of the sum of the values of
    their words and beginnings that are associated with toxic documents; others are
    grade 0."""
    graded = sample.where(F.col("label").isin(0, 1)).select("text", F.col("label").alias("grade"))
    cells = associated_words(graded, min_documents, min_ratio, max_features)
    sent = sample.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, model = WordHasher(), Model(sent.value, np.zeros(0), np.zeros(0))
        for batch in batches:
            found = word_counts(batch.column(0).to_pylist(), hasher)
            shares = [float(model.features(x, c, n)[1].sum()) for x, c, n in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shares, pa.float64())], names=["text", "grade", "share"])

    toxic = materialize(graded.where("grade = 1").mapInArrow(tidy(run), "text string, grade int, share double"))
    cuts = toxic.approxQuantile("share", [i / levels for i in range(1, levels)], 0.01)
    above = sum([F.when(F.col("share") > c, 1).otherwise(0) for c in cuts], F.lit(0))
    return toxic.select("text", (1 + above).alias("grade")).unionByName(graded.where("grade = 0"))


def fit(graded: DataFrame, min_documents: int = 3, min_ratio: float = 30.0, max_features: int = 4096) -> Model:
    """Learn from a bounded sample (text, grade 0, 1, ...; see `labelled_sample`)."""
    sample = graded.where(F.col("grade").isNotNull()).select("text", F.col("grade").cast("int").alias("grade"))
    cells = associated_words(sample, min_documents, min_ratio, max_features)
    none = Model(cells[:0], np.zeros(0), np.zeros(0))
    if len(cells) == 0:
        return none
    rows, cols, vals, grade, weight = training_rows(sample, cells)
    met = np.unique(grade)
    if len(met) < 2:
        return none
    grade = np.searchsorted(met, grade)
    # the two sides of the first threshold weigh alike, however rare toxic documents are
    weight = weight / np.bincount((grade > 0).astype(int), weights=weight)[(grade > 0).astype(int)]
    weights, thresholds = fit_ordinal(rows, cols, vals, grade, weight, len(cells))
    return Model(cells, weights, thresholds)


def score(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The `keep` columns plus grade_probabilities (array<double>), expected_severity and
    is_toxic."""
    sent = docs.sparkSession.sparkContext.broadcast((model.cells, model.weights, model.thresholds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, mine = WordHasher(), Model(*sent.value)
        for batch in batches:
            found = [mine.features(*x) for x in word_counts(batch.column(len(keep)).to_pylist(), hasher)]
            p = mine.grades(np.array([float(v @ mine.weights[f]) for f, v in found]))
            severity = p @ np.arange(p.shape[1])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(keep))), pa.array(p.tolist(), pa.list_(pa.float64())),
                 pa.array(severity, pa.float64()), pa.array(p[:, 0] < 0.5, pa.bool_())],
                names=[*keep, "grade_probabilities", "expected_severity", "is_toxic"])

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.select(*keep, text_of(text_col).alias("_text")).mapInArrow(
        tidy(run), f"{kinds}grade_probabilities array<double>, expected_severity double, is_toxic boolean")
