r"""Language identification with a string kernel.

Two texts are compared by how many character n-grams (of 1 to 3 characters; a blended
spectrum) both contain, whatever their counts, over the square root of the product of their
own numbers. A kernel ridge regression per language, one against the rest, is fitted in the
space of Nyström landmarks: with K the kernel between training texts and landmarks and
M that between landmarks, its weights solve (K' C K + ridge * M) w = K' C y (C weighs the
languages alike). A batch of texts is scored by one matrix product of its n-gram presence
with the landmarks' presence times the weights.

Characters are folded to 64 classes: a blank (anything that is not a letter, runs count
once), a to z, 32 classes of other letters by their code point. n-grams over classes
index arrays directly, so a text of any length costs one pass and fixed memory.

Defined results: a null text, or one without a letter, gets `und` and score 0, as does
every text when nothing was learned. Rows with a null language are never learned from. Equal
texts get equal results; repeated rows keep their own rows. Ties between languages go to
the first by name. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm.common import hash_fraction, small_batches, text_of, tidy

UNDETERMINED = "und"
FIT_TASKS = 12
ORDERS = (1, 2, 3)
CLASSES = 64
OFFSETS = (0, CLASSES, CLASSES + CLASSES ** 2)
GRAMS = CLASSES + CLASSES ** 2 + CLASSES ** 3


def class_table() -> np.ndarray:
    """Class of each code point of the basic plane; others count as its last rows do."""
    table = np.zeros(0x10000, dtype=np.int32)
    for cp in range(0x10000):
        if 97 <= cp <= 122:
            table[cp] = cp - 96
        elif cp > 127 and chr(cp).isalpha():
            table[cp] = 27 + cp % 32
    return table


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class Grams:
    """n-grams of texts over character classes."""

    def __init__(self) -> None:
        self.classes = class_table()
        self.seen = np.zeros(GRAMS, dtype=bool)

    def fold(self, text: str) -> np.ndarray:
        cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        high = cp > 0xFFFF
        if high.any():
            cp = np.where(high, [ord(c) if ord(c) <= 0xFFFF else (0xE9 if c.isalpha() else 32) for c in text.lower()], cp)
        c = self.classes[cp]
        keep = np.ones(len(c) + 2, dtype=bool)
        padded = np.zeros(len(c) + 2, dtype=np.int32)
        padded[1:-1] = c
        keep[1:] = (padded[1:] != 0) | (padded[:-1] != 0)
        return padded[keep]

    def presence(self, text: str) -> np.ndarray:
        """Which n-grams the text has; the array is the object's own, valid until the next call."""
        c = self.fold(text)
        self.seen[:] = False
        self.seen[c] = True
        two = c[:-1] * CLASSES + c[1:]
        self.seen[OFFSETS[1] + two] = True
        self.seen[OFFSETS[2] + two[:-1] * CLASSES + c[2:]] = True
        return self.seen


class Landmarks:
    """Kernel between texts and a bounded set of landmarks: the n-grams that some landmark
    has, and a column per landmark with 1 / sqrt(its n-grams) where it has one."""

    def __init__(self, grams: np.ndarray, matrix: np.ndarray) -> None:
        self.grams, self.matrix = grams, matrix

    @classmethod
    def of(cls, texts: list[str]) -> Landmarks:
        grams = Grams()
        rows = [grams.presence(t).copy() for t in texts]
        used = np.flatnonzero(np.any(rows, axis=0))
        own = np.array([r.sum() for r in rows], dtype=np.float64)
        return cls(used, (np.array([r[used] for r in rows]).T / np.sqrt(own)).astype(np.float32))

    def rows(self, texts: list[str], grams: Grams) -> tuple[np.ndarray, np.ndarray]:
        """Presence of the landmarks' n-grams per text, and 1 / sqrt(the text's n-grams)."""
        out = np.empty((len(texts), len(self.grams)), dtype=np.float32)
        own = np.empty(len(texts))
        for i, t in enumerate(texts):
            seen = grams.presence(t)
            own[i] = np.count_nonzero(seen)
            out[i] = seen[self.grams]
        return out, 1 / np.sqrt(own)


def _spread(values: np.ndarray, best: np.ndarray) -> np.ndarray:
    """The winner's regression value (about -1 to 1) as a score in 0 to 1."""
    return np.clip((values[np.arange(len(best)), best] + 1) / 2, 0, 1)


class Model:
    """Languages, the landmarks' n-grams, and one column of weights per language."""

    def __init__(self, languages: list[str], grams: np.ndarray, weights: np.ndarray) -> None:
        self.languages, self.grams, self.weights = languages, grams, weights

    def predict(self, texts: list[str], grams: Grams) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score, and the share of the text's n-grams that some landmark has."""
        names, scores, known = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        told = [i for i, t in enumerate(texts) if has_letter(t)] if self.languages else []
        if told:
            presence = np.empty((len(told), len(self.grams)), dtype=np.float32)
            own = np.empty(len(told))
            for row, i in enumerate(told):
                seen = grams.presence(texts[i])
                own[row] = np.count_nonzero(seen)
                presence[row] = seen[self.grams]
            values = (presence @ self.weights) / np.sqrt(own)[:, None]
            best = values.argmax(axis=1)
            scores[told] = _spread(values, best)
            known[told] = presence.sum(axis=1) / own
            for row, i in enumerate(told):
                names[i] = self.languages[best[row]]
        return names, scores, known


def sample_by_language(labelled: DataFrame, sizes: DataFrame, key: list[str], per_language: int, seed: int) -> DataFrame:
    """About `per_language` rows of each language, by a hash of the key columns and the
    text; all rows of a language that has no more. `weight` is 1 over the expected number."""
    expected = F.least(F.col("n"), F.lit(per_language))
    return (labelled.join(F.broadcast(sizes), "lang")
            .where(hash_fraction(*key, "text", seed=seed) < expected / F.col("n"))
            .select("text", "lang", (1 / expected).alias("weight")))


def fit(labelled: DataFrame, key: list[str], text_col: str = "text", lang_col: str = "lang",
        n_landmarks: int = 128, rows_per_language: int = 2000, ridge: float = 0.1, seed: int = 7) -> Model:
    """Learn from `labelled` (key columns, text, language). Documented bounds: about
    `rows_per_language` training rows of each language and `n_landmarks` landmarks in all
    (two a language at least), drawn by hash from all rows. The landmarks' texts pass
    through the driver; the training rows do not: tasks sum K' C K and K' C y and the driver
    adds up the sums of a fixed number of tasks."""
    usable = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        *key, F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    spark = labelled.sparkSession
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}  # a row per language
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros(0, dtype=np.int64), np.zeros((0, 0), dtype=np.float32))
    sizes = spark.createDataFrame(sorted(counts.items()), "lang string, n bigint")
    marks = sample_by_language(usable, sizes, key, max(2, n_landmarks // len(languages)), seed).select("text").collect()
    landmarks = Landmarks.of(sorted(r["text"] for r in marks))
    size = len(marks)
    # arrays, not objects: a worker may not have this package
    sent = spark.sparkContext.broadcast((landmarks.grams, landmarks.matrix))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, mine = Grams(), Landmarks(*sent.value)
        both, by_lang = np.zeros((size, size)), np.zeros((len(languages), size))
        for batch in batches:
            texts = batch.column(0).to_pylist()
            lang = np.searchsorted(languages, batch.column(1).to_pylist())
            weight = batch.column(2).to_numpy()
            for at in range(0, len(texts), 256):
                presence, own = mine.rows(texts[at:at + 256], grams)
                k = (presence @ mine.matrix).astype(np.float64) * own[:, None]
                heavy = k * weight[at:at + 256, None]
                both += k.T @ heavy
                np.add.at(by_lang, lang[at:at + 256], heavy)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x.tobytes()], pa.binary()) for x in (both, by_lang)], names=["both", "by_lang"])

    train = sample_by_language(usable, sizes, key, rows_per_language, seed + 1)
    parts = train.repartition(FIT_TASKS).mapInArrow(tidy(sums), "both binary, by_lang binary").collect()
    both = sum(np.frombuffer(bytes(r["both"])).reshape(size, size) for r in parts)
    by_lang = sum(np.frombuffer(bytes(r["by_lang"])).reshape(len(languages), size) for r in parts)
    # y is 1 for the language and -1 for the rest, each language as heavy as another
    right = (2 * by_lang - by_lang.sum(axis=0)).T
    between = landmarks.matrix.T.astype(np.float64) @ landmarks.matrix.astype(np.float64)
    weights = np.linalg.solve(both + ridge / size * between + 1e-8 * np.eye(size), right)
    return Model(languages, landmarks.grams, (landmarks.matrix.astype(np.float64) @ weights).astype(np.float32))


def detector(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """A function of a text column: a struct of lang_pred, score and known, from the text alone.
    `known`, the share of the text's n-grams that some landmark has, tells texts of
    languages that were never learned. Only the text goes to the Python worker and only
    the result comes back."""
    small_batches(spark)
    sent = spark.sparkContext.broadcast((model.languages, model.grams, model.weights))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        grams, mine = Grams(), Model(*sent.value)
        for texts in batches:
            found = [mine.predict(texts[at:at + 256].tolist(), grams) for at in range(0, len(texts), 256)]
            yield pd.DataFrame({"lang_pred": [x for names, _, _ in found for x in names],
                                "score": [x for _, scores, _ in found for x in scores],
                                "known": [x for _, _, known in found for x in known]})

    @F.pandas_udf("lang_pred string, score double, known double")
    def detect(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        return tidy(run)(batches)

    return lambda text: detect(text_of(text))


def predict(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The `keep` columns plus lang_pred, score and known."""
    detect = detector(docs.sparkSession, model)
    return docs.select(*keep, detect(F.col(text_col)).alias("_found")).select(*keep, "_found.*")


def held_out(doc_id: Column) -> Column:
    """Documents that the query keeps from learning: crc32 of the id's text, mod 4, is 2;
    false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
