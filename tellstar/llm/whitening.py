"""Whitening of vectors by a spectral divide and conquer of their covariance.

Spark sums the vectors (exactly, as integers) and their centred products, one table a task and
added up block by block; the driver gets one square matrix for each vector length. There, the
eigenvectors come from polar decompositions (dynamically weighted Halley iterations, by QR
factors): the polar factor of ``H - s I`` is the sign of that matrix, half of it plus the identity
projects on the eigenvectors above ``s``, and an orthonormal basis of that range and of its
complement splits H into two smaller matrices, which are split again. Mean and projection are
broadcast, and every row is whitened where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import doubles, summed, tiles

#: Vectors handled at once in a task.
TILE = 4096
EPS = float(np.finfo(np.float64).eps)


# ---------------------------------------------------------------- spectral divide and conquer

def polar_sign(a: np.ndarray) -> np.ndarray:
    """The polar factor of a symmetric matrix, which is its matrix sign, by weighted Halley steps.
    Singular values of less than rounding size stay between -1 and 1."""
    n, eye = len(a), np.eye(len(a))
    x = a / max(np.linalg.norm(a), np.finfo(np.float64).tiny)
    low = EPS / n  # below the least singular value that differs from zero by more than rounding
    for _ in range(30):
        low2 = min(low, 1.0) ** 2
        d = np.cbrt(4.0 * (1.0 - low2) / low2 ** 2)
        root = np.sqrt(1.0 + d)
        p = root + 0.5 * np.sqrt(max(0.0, 8.0 - 4.0 * d + 8.0 * (2.0 - low2) / (low2 * root)))
        q = (p - 1.0) ** 2 / 4.0
        r = p + q - 1.0
        both, _ = np.linalg.qr(np.concatenate([np.sqrt(r) * x, eye]))
        new = (q / r) * x + (p - q / r) / np.sqrt(r) * (both[:n] @ both[n:].T)
        new = (new + new.T) / 2
        step = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (p + q * low2) / (1.0 + r * low2))
        if step < 1e-14 * n or (1.0 - low < 10 * EPS and step < 1e-5):
            break
    return x


def _shifts(h: np.ndarray) -> Iterator[float]:
    """Where to split: between the median and the mean of the diagonal, then beside the mean
    (which lies between the least and the largest eigenvalue, unless all are the same)."""
    diagonal = np.diag(h)
    mean, spread = float(diagonal.mean()), np.linalg.norm(h - diagonal.mean() * np.eye(len(h))) / np.sqrt(len(h))
    yield float(np.median(diagonal))
    yield mean
    for part in (0.1, -0.1, 0.3, -0.3, 0.03, -0.03, 0.5, -0.5, 0.01, -0.01, 0.003, -0.003, 0.7, -0.7, 0.9, -0.9):
        yield mean + part * spread


def split(h: np.ndarray, size: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the eigenvectors above and below a shift; None if all eigenvalues are
    equal to the rounding of a matrix of the norm ``size``."""
    n = len(h)
    if n == 1 or np.linalg.norm(h - np.trace(h) / n * np.eye(n)) <= 4 * EPS * n * size:
        return None
    best = None
    for shift in _shifts(h):
        projector = (polar_sign(h - shift * np.eye(n)) + np.eye(n)) / 2
        rank = int(round(float(np.trace(projector))))
        if not 0 < rank < n:
            continue
        start = np.random.default_rng(n).normal(size=(n, rank))
        basis, _ = np.linalg.qr(projector @ start)
        basis, _ = np.linalg.qr(projector @ basis, mode="complete")
        above, below = basis[:, :rank], basis[:, rank:]
        off = np.linalg.norm(below.T @ h @ above)
        if best is None or off < best[0]:
            best = off, above, below
        if off <= 8 * EPS * np.sqrt(n) * size:
            break
    return None if best is None else best[1:]


def eigenvectors(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors (as
    columns; their largest entry is positive). Only invariant subspaces that hold one of these
    are split on."""
    size = float(np.linalg.norm(v))
    parts: list[np.ndarray] = [np.eye(len(v))]
    found: list[np.ndarray] = []
    while parts and len(found) < most:
        basis = parts.pop()  # the last holds the largest eigenvalues of those left
        h = basis.T @ v @ basis
        two = split((h + h.T) / 2, size)
        if two is None:
            found += list(basis.T)
        else:
            parts += [np.linalg.qr(basis @ two[1])[0], np.linalg.qr(basis @ two[0])[0]]
    basis = np.stack(found, axis=1) if found else np.empty((len(v), 0))
    values = np.einsum("ij,ij->j", basis, v @ basis)
    order = np.argsort(-values, kind="stable")[:most]
    basis = basis[:, order] / np.linalg.norm(basis[:, order], axis=0)
    largest = np.take_along_axis(basis, np.abs(basis).argmax(axis=0)[None, :], axis=0)
    return values[order], basis * np.where(largest < 0, -1.0, 1.0)


# ---------------------------------------------------------------- sums over all vectors

@dataclass
class Fit:
    """Of the vectors of one length: how many, exact sums, and what whitens them."""

    n: int
    sums: list[int]
    projection: np.ndarray | None = None  # (dimension, components)
    explained: np.ndarray | None = None
    identity_error: float = 0.0

    def __post_init__(self):
        self.whole = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = [s % self.n for s in self.sums]
        self.part = np.array([r / self.n for r in self.rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.part

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.projection

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - sum)^2, exact."""
        y = x - self.whole
        if x.shape[1] * (self.n * (float(np.abs(y).max(initial=0)) + 1.0)) ** 2 < 2.0 ** 62:
            return ((self.n * y - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        return [sum((self.n * a - r) ** 2 for a, r in zip(row, self.rest)) for row in y.tolist()]


def whole_numbers(m: np.ndarray, scale: int, offset: int) -> np.ndarray:
    return np.floor(scale * m).astype(np.int64) + offset


def taking_part(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, v): vectors that are there, finite, and in the range of 2^60 when scaled."""
    frame = doubles(vectors, F.col("vec_id"))
    return frame.where(F.forall("v", lambda x: F.abs(x) < F.lit(2.0 ** 60 / scale)))


def counted(frame: DataFrame, scale: int, offset: int) -> dict[int, Fit]:
    """Number and exact sums of the vectors of each length (above 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
        for _, by_dim in tiles(batches, TILE):
            for dim, (_, m) in by_dim.items():
                x = whole_numbers(m, scale, offset)
                n, high, low = sums.get(dim, (0, 0, 0))
                sums[dim] = n + len(x), high + (x >> 30).sum(axis=0), low + (x & ((1 << 30) - 1)).sum(axis=0)
        for dim, (n, high, low) in sums.items():
            yield pa.RecordBatch.from_pydict({"dim": pa.array([dim] * dim, pa.int32()), "at": pa.array(range(dim), pa.int32()), "n": pa.array([n] * dim, pa.int64()), "high": high, "low": low})

    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]
    found: dict[int, dict[int, tuple[int, int]]] = {}
    for r in frame.mapInArrow(run, "dim int, at int, n long, high long, low long").groupBy("dim", "at").agg(*exact).collect():
        found.setdefault(r.dim, {})[r.at] = int(r.n), (int(r.high) << 30) + int(r.low)
    return {dim: Fit(at[0][0], [at[i][1] for i in range(dim)]) for dim, at in found.items()}


def _products(frame: DataFrame, shared: Broadcast, scale: int, offset: int, rows_of) -> dict[int, np.ndarray]:
    """By length, the sum of ``rows_of(fit, x).T @ rows_of(fit, x)`` over all vectors."""

    def tables(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        sums: dict[int, np.ndarray] = {}
        for _, by_dim in tiles(batches, TILE):
            for dim, (_, m) in by_dim.items():
                fit = shared.value.get(dim)
                if fit is not None:
                    rows = rows_of(fit, whole_numbers(m, scale, offset))
                    sums[dim] = sums.get(dim, 0.0) + rows.T @ rows
        return sums

    return summed(frame, tables)


def fitted(vectors: DataFrame, components: int = 8, scale: int = 1024, offset: int = 100000) -> dict[int, Fit]:
    """What whitens the vectors of each length, fitted on all of them.

    Components are numbered by falling eigenvalue. One whose eigenvalue is zero to rounding has no
    whitened value and is left out, so vectors that are all the same have no component."""
    context, frame = vectors.sparkSession.sparkContext, taking_part(vectors, scale)
    fits = counted(frame, scale, offset)
    moments = _products(frame, context.broadcast(fits), scale, offset, lambda fit, x: fit.centred(x))
    for dim, fit in fits.items():
        v = moments[dim].reshape(dim, dim) / fit.n
        v = (v + v.T) / 2
        values, basis = eigenvectors(v, min(components, dim))
        some = values > EPS * dim * max(float(values.max(initial=0)), 0.0)
        fit.projection = basis[:, some] / np.sqrt(values[some])
        fit.explained = values[some] / np.trace(v) if some.any() else np.empty(0)
    used = {dim: fit for dim, fit in fits.items() if len(fit.explained)}
    ones = _products(frame, context.broadcast(used), scale, offset,
                     lambda fit, x: np.concatenate([fit.whitened(x), np.ones((len(x), 1))], axis=1))
    for dim, fit in used.items():
        k = len(fit.explained)
        table = ones[dim].reshape(k + 1, k + 1) / fit.n
        fit.identity_error = float(np.abs(table[:k, :k] - np.outer(table[:k, k], table[:k, k]) - np.eye(k)).max())
    return used


def whitened(vectors: DataFrame, components: int = 8, scale: int = 1024, offset: int = 100000) -> DataFrame:
    """(vec_id, component from 1, n, deviation, whitened, explained, identity_error,
    deviation_exact): one row for each vector and component.

    Each component c of a vector becomes floor(scale * c) + offset. Vectors that are null or hold
    a null or non-finite component take no part, nor do those that leave +-2^60 when scaled.
    Vectors of another length are whitened among themselves; empty ones have no component. A null
    or repeated vec_id is a row like any other. ``deviation`` is null where it does not fit a long;
    ``deviation_exact`` (a decimal of 38 digits) is null where that does not hold it either."""
    shared = vectors.sparkSession.sparkContext.broadcast(fitted(vectors, components, scale, offset))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, by_dim in tiles(batches, TILE):
            for dim, (at, m) in by_dim.items():
                fit = shared.value.get(dim)
                if fit is None:
                    continue
                x, k = whole_numbers(m, scale, offset), len(fit.explained)
                off = fit.deviation(x)
                each = np.repeat(np.arange(len(x)), k)
                long = pa.array([d if d < 1 << 63 else None for d in off], pa.int64())
                exact = pa.array([d if d < 10 ** 38 else None for d in off], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_pydict({
                    "vec_id": table.column("vec_id").combine_chunks().take(pa.array(at[each])),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), "n": pa.array(np.full(len(each), fit.n, np.int64)),
                    "deviation": long.take(pa.array(each)), "whitened": fit.whitened(x).ravel(), "explained": np.tile(fit.explained, len(x)),
                    "identity_error": np.full(len(each), fit.identity_error), "deviation_exact": exact.take(pa.array(each))})

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return taking_part(vectors, scale).mapInArrow(
        run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)")
