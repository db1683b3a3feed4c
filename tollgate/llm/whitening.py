r"""Whitening of embeddings, with eigenvectors found by spectrum slicing.

A vector's entry c counts as the integer x = floor(1024 c) + 100000, so counts, sums and sums of
products are exact integers whatever the order they are added in:

1. rows and sums per dimension;
2. sums of products of x - floor(mean), centred on the integer below the mean, and from them
   the covariance V, each entry rounded once;
3. on the driver, eigenvalues and eigenvectors of V (a matrix of the dimension's size): the
   inertia of V - t I, counted by an LDL^T factorisation, says how many eigenvalues lie
   above t. Bisection on that count isolates each leading eigenvalue, Rayleigh quotient
   iteration converges to its eigenvector, and counts just below and above
   certify its number. Eigenvalues too close to separate are a cluster, whose vectors are
   made orthogonal to one another;
4. every vector is projected, and the covariance of what comes out is measured.

Each step is one scan; tasks hand on sums of a size that depends on the dimension only.

Defined results: vectors that are null, empty, or hold a null or non-finite entry, or one
whose x passes 53 bits, are dropped. The dimension is that of most vectors (on a tie the
greater); vectors of another length are dropped too. Repeated rows and ids, null ids: a row each. A
component whose eigenvalue is zero to double precision cannot be scaled to variance one and has no rows;
so vectors that are all alike give none, nor does a table without vectors. `deviation`
is null where it passes 64 bits. Other columns are not read.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import tidy

SCALE, SHIFT = 1024, 100_000
MOST = 2.0 ** 53
COMPONENTS = 8
EPS = float(np.finfo(float).eps)


# ---- spectrum of a symmetric matrix ------------------------------------------

def eigenvalues_above(matrix: np.ndarray, t: float) -> int:
    """Number of eigenvalues above t: the positive part of the inertia of matrix - t I, from a
    symmetric-pivoted LDL^T factorisation with blocks of one and two rows."""
    a = matrix - t * np.eye(len(matrix))
    tiny = EPS * max(np.abs(a).max(), 1e-300) * EPS
    n = above = 0
    size = len(a)
    alpha = (1 + 17 ** 0.5) / 8
    while n < size:
        s = a[n:, n:]
        d = np.abs(np.diagonal(s))
        p = int(d.argmax())
        off = np.abs(s - np.diag(np.diagonal(s)))
        i, j = np.unravel_index(int(off.argmax()), off.shape)
        if d[p] >= alpha * off[i, j]:
            s[[0, p]] = s[[p, 0]]
            s[:, [0, p]] = s[:, [p, 0]]
            pivot = s[0, 0]
            if abs(pivot) <= tiny:  # the rest is zero: eigenvalues at t, not above
                break
            above += pivot > 0
            column = s[1:, 0].copy()
            s[1:, 1:] -= np.outer(column, column) / pivot
            n += 1
        else:
            order = [i, j, *(k for k in range(len(s)) if k not in (i, j))]
            s[:] = s[np.ix_(order, order)]
            above += 1  # such a block has one eigenvalue of either sign
            block = s[:2, :2].copy()
            columns = s[2:, :2].copy()
            s[2:, 2:] -= columns @ np.linalg.solve(block, columns.T)
            n += 2
    return above


@dataclasses.dataclass
class Spectrum:
    """Leading eigenvalues (falling) and unit eigenvectors (columns); `certified[k]`: the counts
    of eigenvalues just below and just above the value agree with its number."""

    values: np.ndarray
    vectors: np.ndarray
    certified: list[bool]


def _improve(matrix: np.ndarray, shift: float, start: np.ndarray, known: np.ndarray, scale: float) -> tuple[float, np.ndarray]:
    """Inverse iteration at `shift`, then Rayleigh quotient iteration, orthogonal to `known`."""
    identity, v, value = np.eye(len(matrix)), start, shift
    best = (np.inf, shift, start)
    for step in range(60):
        at = shift if step < 2 else value
        try:
            v = np.linalg.solve(matrix - at * identity, v)
        except np.linalg.LinAlgError:
            v = np.linalg.solve(matrix - (at + 4 * EPS * scale) * identity, v)
        for _ in range(2):
            v = v - known @ (known.T @ v)
        v /= np.linalg.norm(v)
        value = float(v @ matrix @ v)
        left = float(np.linalg.norm(matrix @ v - value * v))
        if left < best[0]:
            best = (left, value, v)
        elif step > 3:
            break
    return best[1], best[2]


def leading_spectrum(matrix: np.ndarray, most: int = COMPONENTS) -> Spectrum:
    """The `most` greatest eigenvalues of a symmetric matrix that are above zero to double
    precision, by spectrum slicing."""
    size = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max()) if size else 0.0
    if scale == 0:
        return Spectrum(np.zeros(0), np.zeros((size, 0)), [])
    counts: dict[float, int] = {}

    def above(t: float) -> int:
        if t not in counts:
            counts[t] = eigenvalues_above(matrix, t)
        return counts[t]

    floor = 8 * size * EPS * scale  # rounding alone can make eigenvalues of this size
    values, vectors, certified = [], np.zeros((size, 0)), []
    for k in range(1, min(most, above(floor)) + 1):
        low, high = floor, scale * (1 + 4 * EPS)
        for t, c in counts.items():  # what earlier slices tell
            if c >= k:
                low = max(low, t)
            else:
                high = min(high, t)
        while True:
            alone = above(low) == k and above(high) == k - 1
            narrow = high - low <= 4 * EPS * scale
            if alone or narrow:
                middle = (low + high) / 2
                start = np.cos(np.arange(1, size + 1) * (1.0 + k))  # fixed, in no special direction
                value, v = _improve(matrix, middle, start / np.linalg.norm(start), vectors, scale)
                slack = 64 * EPS * scale
                sure = above(value - slack) >= k and above(value + slack) <= k - 1
                if sure or narrow:
                    break
            middle = (low + high) / 2
            if above(middle) >= k:
                low = middle
            else:
                high = middle
        values.append(value)
        vectors = np.column_stack([vectors, v])
        certified.append(sure)
    order = np.argsort(-np.array(values), kind="stable")
    return Spectrum(np.array(values)[order], vectors[:, order], [certified[i] for i in order])


# ---- scans over the vectors ----------------------------------------------------

def _scaled(lists: pa.Array, dim: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, places of the rows, their x as floats that are whole numbers) of each length
    among the sound vectors of a batch; of one dimension only if it is given."""
    values = lists.values.to_numpy(zero_copy_only=False).astype(float, copy=False)  # null: nan
    at = lists.offsets.to_numpy().astype(np.int64)
    length = np.diff(at)
    there = np.ones(len(lists), dtype=bool) if lists.null_count == 0 else ~np.asarray(lists.is_null())
    for d in np.unique(length[there & (length > 0)]) if dim is None else [dim]:
        rows = np.flatnonzero(there & (length == d))
        with np.errstate(invalid="ignore", over="ignore"):
            x = np.floor(values[at[rows][:, None] + np.arange(d)] * SCALE) + SHIFT
            sound = (np.abs(x) < MOST).all(axis=1)
        yield int(d), rows[sound], x[sound]


def _sums(vectors: DataFrame) -> tuple[int, int, list[int]]:
    """(dimension, rows, sums per dimension), exact."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for d, rows, x in _scaled(batch.column(0)):
                safe = len(x) * (np.abs(x).max() if x.size else 0) < MOST
                s = x.sum(axis=0).astype(np.int64) if safe else x.astype(np.int64).astype(object).sum(axis=0)
                n, old = total.get(d, (0, np.zeros(d, dtype=object)))
                total[d] = (n + len(rows), old + s.astype(object))
        for d, (n, s) in total.items():
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([d] * (d + 1), pa.int32()), pa.array(range(-1, d), pa.int32()),
                                                  pa.array([Decimal(n), *map(Decimal, s)], pa.decimal128(38, 0))],
                                                 names=["dim", "i", "s"])

    parts = vectors.mapInArrow(tidy(run), "dim int, i int, s decimal(38,0)").groupBy("dim", "i").agg(F.sum("s").alias("s"))
    counts = parts.where("i = -1").orderBy(F.desc("s"), F.desc("dim")).limit(1).collect()
    if not counts:
        return 0, 0, []
    dim = counts[0]["dim"]
    got = {r["i"]: int(r["s"]) for r in parts.where(F.col("dim") == dim).collect()}
    return dim, got[-1], [got[i] for i in range(dim)]


def _covariance(vectors: DataFrame, dim: int, n: int, sums: list[int]) -> np.ndarray:
    """The covariance (divisor n) of x, from exact sums of centred products."""
    centre = [s // n for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre)]  # sums of x - centre
    upper = np.triu_indices(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle, total = np.array(centre, dtype=float), np.zeros((dim, dim), dtype=object)
        seen = False
        for batch in batches:
            for _, _, x in _scaled(batch.column(0), dim):
                if not len(x):
                    continue
                y, seen = x - middle, True
                if np.abs(y).max() ** 2 * len(y) < MOST:  # every partial sum is exact
                    total = total + (y.T @ y).astype(np.int64).astype(object)
                else:
                    whole = y.astype(np.int64).astype(object)
                    total = total + whole.T @ whole
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(upper[0])), pa.int32()),
                                              pa.array(map(Decimal, total[upper]), pa.decimal128(38, 0))], names=["i", "s"])

    parts = vectors.mapInArrow(tidy(run), "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s"))
    out = np.zeros((dim, dim))
    for r in parts.collect():  # as many as a triangle of the matrix
        i, j = int(upper[0][r["i"]]), int(upper[1][r["i"]])
        out[i, j] = out[j, i] = (n * int(r["s"]) - rest[i] * rest[j]) / (n * n)
    return out


@dataclasses.dataclass
class Whitener:
    """What whitens a vector: rows and sums of the fit list, eigenvalues, eigenvectors, trace."""

    dim: int
    n: int
    sums: list[int]
    spectrum: Spectrum
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """Rows of x, centred (first on a whole number, which is exact), projected and scaled."""
        whole = np.array([s // self.n for s in self.sums], dtype=float)
        part = np.array([(s % self.n) / self.n for s in self.sums])
        return ((x - whole) - part) @ self.spectrum.vectors / np.sqrt(self.spectrum.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2 of each row, exact; null beyond 64 bits."""
        centre = np.array([s // self.n for s in self.sums], dtype=float)
        rest = np.array([s % self.n for s in self.sums], dtype=np.int64)
        y = (x - centre).astype(np.int64)
        if x.size == 0:
            return []
        if (float(np.abs(y).max()) * self.n + self.n) ** 2 * self.dim < 2.0 ** 62:
            return ((self.n * y - rest) ** 2).sum(axis=1).tolist()
        far = ((self.n * y.astype(object) - rest.astype(object)) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in far]


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitener | None:
    """Learns from all sound vectors; None where there are none."""
    column = vectors.select(F.col(vector_col).cast("array<double>").alias("v"))
    dim, n, sums = _sums(column)
    if n == 0:
        return None
    v = _covariance(column, dim, n, sums)
    return Whitener(dim, n, sums, leading_spectrum(v, components), float(np.trace(v)))


def identity_error(vectors: DataFrame, model: Whitener, vector_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity. Sums of
    tasks are added as decimals, so that their order does not matter."""
    k, upper = len(model.spectrum.values), np.triu_indices(len(model.spectrum.values))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + len(upper[0]))
        for batch in batches:
            for _, _, x in _scaled(batch.column(0), model.dim):
                w = model.project(x)
                total += np.concatenate([w.sum(axis=0), (w.T @ w)[upper]])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["i", "s"])

    parts = vectors.select(F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(tidy(run), "i int, s double")
    got = {r["i"]: float(r["s"]) / model.n for r in
           parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,18)")).alias("s")).collect()}
    mean = np.array([got[i] for i in range(k)])
    worst = 0.0
    for at, (i, j) in enumerate(zip(*upper)):
        worst = max(worst, abs(got[k + at] - mean[i] * mean[j] - (i == j)))
    return worst


def whiten(vectors: DataFrame, model: Whitener | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row per sound vector and component: the id, component (from 1), n, deviation,
    whitened, explained, identity_error, certified."""
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double, certified boolean")
    if model is None or len(model.spectrum.values) == 0:
        return vectors.sparkSession.createDataFrame([], schema)
    error, k = identity_error(vectors, model, vector_col), len(model.spectrum.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, rows, x in _scaled(batch.column(1), model.dim):
                m = len(rows)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, model.n)), pa.array(model.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(model.project(x).ravel()), pa.array(np.tile(model.spectrum.values / model.trace, m)),
                    pa.array(np.full(m * k, error)), pa.array(np.tile(model.spectrum.certified, m))],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error", "certified"])

    return vectors.select(id_col, F.col(vector_col).cast("array<double>").alias("_v")).mapInArrow(tidy(run), schema)
