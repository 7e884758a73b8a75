"""Embedding whitening: principal components of a large table of vectors, scaled to unit variance.

Entries become whole numbers, x = floor(1024 c) + 100000.  Tasks sum them exactly; with the means known, a second scan
sums each task's centred products, a triangle of the covariance a task, and Spark adds the triangles.  The driver gets
that one matrix (dimension * (dimension + 1) / 2 numbers) and finds the leading components: Householder reflections
make it tridiagonal, Sturm counts bisect the leading eigenvalues, inverse iteration gives the vectors, kept
orthogonal among eigenvalues that lie close together, and the reflections carry them back.  Means and components are
broadcast, and a last scan projects every row.

Edge cases: vectors that are null, empty, or hold null or non-finite entries are dropped; if vectors differ in length,
those of the most frequent one (of the longer, when tied) count and the others are dropped; null and repeated ids are
rows like any other; components stop where the eigenvalue is no longer positive beyond rounding (fewer rows than
dimensions, equal vectors: none at all); ``deviation`` is null where it exceeds a long; extra columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import prepare, quoted, written

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Eigenvalues nearer than this share of the matrix' norm form a cluster, whose vectors are made orthogonal.
CLUSTER = 1e-3
#: Eigenvalues up to this share of the largest count as zero.
NOTHING = 1e-12
#: Rows of a matrix product.
ROWS = 8192


# --- eigenvectors of a symmetric matrix ------------------------------------------

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Diagonal, off-diagonal and the Householder vectors of the reflections that lead there."""
    a, n = matrix.astype(float).copy(), len(matrix)
    off, mirrors = np.zeros(max(n - 1, 0)), []
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        size = np.linalg.norm(x)
        if not np.any(x[1:]):  # nothing to mirror away
            off[k] = x[0]
            mirrors.append(None)
            continue
        off[k] = -np.copysign(size, x[0])
        x[0] -= off[k]
        v = x / np.linalg.norm(x)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        q = p - (v @ p) * v
        rest -= 2 * (np.outer(v, q) + np.outer(q, v))
        mirrors.append(v)
    if n > 1:
        off[n - 2] = a[n - 1, n - 2]
    return np.diag(a).copy(), off, mirrors


def sturm_counts(diag: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each value of ``at``, the number of eigenvalues below it: negative pivots of T - value."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    below, pivot = np.zeros(len(at), int), np.ones(len(at))
    for k in range(len(diag)):
        pivot = diag[k] - at - (off[k - 1] ** 2 / pivot if k else 0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        below += pivot < 0
    return below


def leading_eigenvalues(diag: np.ndarray, off: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` largest eigenvalues, falling, by bisection."""
    n = len(diag)
    wanted = n - np.arange(min(most, n))  # place in rising order, from 1
    around = np.zeros(n)
    around[:-1] += np.abs(off)
    around[1:] += np.abs(off)
    eps = np.finfo(float).eps
    low, high = np.full(len(wanted), (diag - around).min()), np.full(len(wanted), (diag + around).max())
    slack = eps * max(abs(low[0]), abs(high[0]), np.finfo(float).tiny) * 4
    low, high = low - slack, high + slack
    for _ in range(200):
        middle = low + (high - low) / 2
        if np.all(high - low <= 2 * eps * np.maximum(np.abs(low), np.abs(high))):
            break
        found = sturm_counts(diag, off, middle) >= wanted
        high, low = np.where(found, middle, high), np.where(found, low, middle)
    return low + (high - low) / 2


def _solve(diag: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """(T - shift) x = b by elimination with row exchanges; pivots of zero become ``least``."""
    n = len(diag)
    main, up, up2, x = (diag - shift).tolist(), [*off.tolist(), 0.0], [0.0] * n, b.tolist()
    low = off.tolist()
    for k in range(n - 1):
        if abs(low[k]) > abs(main[k]):
            factor = main[k] / low[k]
            main[k], up[k], up2[k], main[k + 1], up[k + 1] = low[k], main[k + 1], up[k + 1], up[k] - factor * main[k + 1], -factor * up[k + 1]
            x[k], x[k + 1] = x[k + 1], x[k] - factor * x[k + 1]
        else:
            main[k] = main[k] or least
            factor = low[k] / main[k]
            main[k + 1] -= factor * up[k]
            x[k + 1] -= factor * x[k]
    for k in reversed(range(n)):
        rest = x[k] - (up[k] * x[k + 1] if k + 1 < n else 0.0) - (up2[k] * x[k + 2] if k + 2 < n else 0.0)
        pivot = main[k] if abs(main[k]) >= least else float(np.copysign(least, main[k]))
        x[k] = rest / pivot
        if abs(x[k]) > 1e150:  # only the direction counts
            scale = abs(x[k])
            x = [v / scale for v in x]
    return np.array(x)


def inverse_iteration(diag: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of falling eigenvalues; within a cluster each is kept orthogonal to those before."""
    n, eps = len(diag), np.finfo(float).eps
    norm = max(np.abs(diag).max(initial=0), np.abs(off).max(initial=0), np.finfo(float).tiny)
    random, vectors = np.random.default_rng(11), np.zeros((n, len(values)))
    start, last = 0, None  # first of the cluster, the shift before
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            start, last = k, None
        shift = value if last is None else min(value, last - 2 * eps * norm)  # not the same system twice
        last, before = shift, vectors[:, start:k]
        x = random.standard_normal(n)
        for _ in range(6):
            x = _solve(diag, off, shift, x / np.linalg.norm(x), eps * norm)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= before @ (before.T @ x)
        vectors[:, k] = x / np.linalg.norm(x)
    return vectors


def leading_components(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    diag, off, mirrors = tridiagonal(matrix)
    values = leading_eigenvalues(diag, off, most)
    vectors = inverse_iteration(diag, off, values)
    for k in reversed(range(len(mirrors))):
        if (v := mirrors[k]) is not None:
            vectors[k + 1:] -= 2 * np.outer(v, v @ vectors[k + 1:])
    return values, vectors / np.linalg.norm(vectors, axis=0)


# --- sums over the table -----------------------------------------------------------

def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, x) for each length of the usable vectors of a list column, in blocks of ``ROWS`` rows."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)  # null entries become NaN
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        for at in range(0, len(rows), ROWS):
            some = rows[at:at + ROWS]
            found = values[starts[some][:, None] + np.arange(size)]
            whole = np.isfinite(found).all(axis=1)
            yield some[whole], np.floor(SCALE * found[whole]).astype(np.int64) + SHIFT


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, list] = {}
    for batch in batches:
        for rows, x in _vectors(batch.column(0)):
            if len(rows):
                total = found.setdefault(x.shape[1], [0, np.zeros(x.shape[1], np.int64)])
                total[0] += len(rows)
                total[1] += x.sum(axis=0)
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([n for n, _ in found.values()], pa.int64()),
                                          pa.array([s for _, s in found.values()], pa.list_(pa.int64()))], names=["size", "n", "sums"])


@dataclass
class Whitening:
    """Number of vectors, sums of x, falling eigenvalues, unit components as columns and the covariance's trace."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float


class _Products:
    def __init__(self, mean: np.ndarray):
        self.mean = mean

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(self.mean)
        total = np.zeros((d, d))
        for batch in batches:
            for rows, x in _vectors(batch.column(0)):
                if x.shape[1] == d and len(rows):
                    centred = x - self.mean
                    total += centred.T @ centred
        yield pa.RecordBatch.from_arrays([pa.array([total[np.triu_indices(d)]], pa.list_(pa.float64()))], names=["products"])


class _Project:
    """Rows (id, vector) -> id, deviation, whitened."""

    def __init__(self, model):
        self.model = model

    def __call__(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Whitening = self.model.value
        mean, scaled, k = m.sums / m.n, m.vectors / np.sqrt(m.values), len(m.values)
        for batch in batches:
            for rows, x in _vectors(batch.column(1)):
                if x.shape[1] != len(m.sums) or not len(rows):
                    continue
                away = x - mean
                if m.n * np.abs(x).max() < 2**62 and (m.n * away ** 2 * m.n).sum(axis=1).max() < 2**62:
                    deviation = pa.array(((m.n * x - m.sums) ** 2).sum(axis=1), pa.int64())
                else:
                    exact = [sum((m.n * a - s) ** 2 for a, s in zip(r, m.sums.tolist())) for r in x.tolist()]
                    deviation = pa.array([v if v < 2**63 else None for v in exact], pa.int64())
                white = pa.FixedSizeListArray.from_arrays(pa.array((away @ scaled).ravel()), k).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), deviation, white], names=["id", "deviation", "whitened"])


def fit(df: DataFrame, vector: str = "embedding", most: int = COMPONENTS) -> Whitening | None:
    """The leading components of all usable vectors; None without any vector or variance."""
    prepare(df.sparkSession)
    vectors = df.select(df[quoted(vector)].cast("array<double>").alias("vector"))
    sums = written(vectors.mapInArrow(_sums, "size int, n long, sums array<long>"))  # a row a task and length
    common = sums.groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if common is None:
        return None
    of = sums.filter(F.col("size") == common["size"]).select(F.posexplode("sums").alias("at", "total"))
    total = np.array([r.total for r in of.groupBy("at").agg(F.sum("total").alias("total")).orderBy("at").collect()], np.int64)
    products = vectors.mapInArrow(_Products(total / common["n"]), "products array<double>").select(F.posexplode("products").alias("at", "total"))
    d = len(total)
    matrix = np.zeros((d, d))
    matrix[np.triu_indices(d)] = [r.total for r in products.groupBy("at").agg(F.sum("total").alias("total")).orderBy("at").collect()]
    matrix = (matrix + np.triu(matrix, 1).T) / common["n"]
    values, components = leading_components(matrix, most)
    some = values > NOTHING * values[0]
    return Whitening(common["n"], total, values[some], components[:, some], float(np.trace(matrix))) if some.any() else None


def project(df: DataFrame, model: Whitening, vector: str = "embedding", id_: str = "vec_id") -> DataFrame:
    """id, deviation and whitened (a value a component) of every usable row of the model's dimension."""
    prepare(df.sparkSession)
    rows = df.select(df[quoted(id_)].alias("id"), df[quoted(vector)].cast("array<double>").alias("vector"))
    shared = df.sparkSession.sparkContext.broadcast(model)  # (dimension + 1) * components numbers and the sums
    return rows.mapInArrow(_Project(shared), f"id {rows.schema['id'].dataType.simpleString()}, deviation long, whitened array<double>")


def identity_error(projected: DataFrame, k: int) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, in size."""
    at = lambda i: F.col("whitened")[i]
    means = projected.agg(*[F.avg(at(i)) for i in range(k)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = projected.agg(*[F.avg((at(i) - F.lit(means[i])) * (at(j) - F.lit(means[j]))) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs))


def whiten(df: DataFrame, vector: str = "embedding", id_: str = "vec_id", most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error, a row for each usable vector and component."""
    model = fit(df, vector, most)
    names = f"{id_} {df.schema[id_].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return df.sparkSession.createDataFrame([], names)
    projected = written(project(df, model, vector, id_))
    error = identity_error(projected, len(model.values))
    parts = [F.struct(F.lit(k + 1).alias("component"), F.col("whitened")[k].alias("whitened"), F.lit(float(e / model.trace)).alias("explained")) for k, e in enumerate(model.values)]
    rows = projected.select(F.col("id").alias(id_), "deviation", F.explode(F.array(*parts)).alias("c"))
    return rows.select(id_, "c.component", F.lit(model.n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained", F.lit(error).alias("identity_error"))
