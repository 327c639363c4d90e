"""Embedding whitening by incremental eigendecomposition (operator 11).

Vectors are whole numbers x here (see ``integer_vectors``), so their sums and deviations are exact.

1. Every partition keeps a ``Spectrum`` of the vectors it has seen: how many, their mean, and the eigendecomposition of their scatter
   matrix. A vector v changes the scatter by n/(n+1) (v-mean)(v-mean)^T, a centred rank-one update. In the basis of the
   eigenvectors that is a diagonal matrix plus z z^T, whose eigenvalues are the roots of the secular equation
   1 + sum z_i^2 / (d_i - t) = 0, one between each two neighbouring poles.
2. Before it is solved, eigenpairs that the update does not touch are set aside (deflation): those with a negligible z_i, and of two equal
   or almost equal eigenvalues the one whose z_i a rotation makes zero. The roots are found all at once, each relative to its nearer pole,
   by rational steps inside a shrinking bracket; z is then recomputed from the roots, so that the new eigenvectors are
   orthogonal to working precision.
3. Partitions' spectra are combined in groups of a few, group by group: the smaller one's eigenpairs and the difference of the means
   go into the larger one as rank-one updates. A spectrum has the square of the dimension in numbers, whatever it has seen; only the
   last one reaches the driver.
4. Rayleigh-Ritz refinement over all rows: the eigenvectors are made orthonormal, every row, centred exactly as (n x - S) / n, is projected on
   them, and the covariance of the projections (almost diagonal) is summed over partitions and diagonalised. This takes away what
   rounding the many updates have left. Components are the leading Ritz vectors, the largest entry positive.

Rows: vectors that are null or hold null or non-finite entries (or one whose whole number is no long) are dropped. Vectors of another length
are a population of their own, with n, components and error of that length; empty vectors have no components and give no rows.
Vectors of fewer dimensions than components have as many components as dimensions. Where an eigenvalue is zero within rounding
(few rows, equal vectors, constant dimensions) the component's whitened value is null and it is left out of the identity error, which is null if
no component is left; explained is null if all rows are equal. A deviation that does not fit a long is null. Repeated rows and rows without vec_id
count and are returned as they are; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.integer_vectors import by_size, fits_long, matrix, whole_vectors
from ledgerloom.session import materialize

COMPONENTS, SCALE, SHIFT, FAN_IN = 8, 1024, 100_000, 16
_EPS = np.finfo(np.float64).eps


# --- one rank-one update ------------------------------------------------------------------

def secular_roots(poles: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(roots, differences): the eigenvalues of diag(poles) + z z^T, and poles (rows) minus roots (columns) without cancellation.

    ``poles`` ascend strictly and no z is zero, so root i lies between pole i and the next one, the last one within z.z of its pole.
    """
    k, squares = len(poles), z * z
    if k == 1:
        return poles + squares, -squares.reshape(1, 1)
    ends = np.append(poles[1:], poles[-1] + squares.sum())
    half = (ends - poles) / 2.0
    at_half = 1.0 + (squares[:, None] / ((poles[:, None] - poles[None, :]) - half[None, :])).sum(axis=0)
    right = at_half < 0.0  # the root lies in the right half
    nearer = np.where(right, np.minimum(np.arange(k) + 1, k - 1), np.arange(k))
    nearer[-1] = k - 1
    low, high = np.where(right, -half, 0.0), np.where(right, 0.0, half)
    low[-1], high[-1] = (half[-1], 2.0 * half[-1]) if right[-1] else (0.0, half[-1])
    shifted = poles[:, None] - poles[nearer][None, :]
    own = np.arange(k)
    first, second = np.minimum(own, k - 2), np.minimum(own + 1, k - 1)  # the two poles of the rational model
    upto = np.tri(k, dtype=bool).T  # [j, i]: pole j is at or below pole i
    upto[k - 1, k - 1] = False
    step_at = (low + high) / 2.0
    for round_ in range(100):
        gap = shifted - step_at[None, :]
        terms = squares[:, None] / gap
        value = 1.0 + terms.sum(axis=0)
        low, high = np.where(value < 0.0, step_at, low), np.where(value < 0.0, high, step_at)
        done = (np.abs(value) <= k * _EPS * (1.0 + np.abs(terms).sum(axis=0))) | (high - low <= 2.0 * _EPS * np.maximum(np.abs(low), np.abs(high)))
        if done.all():
            break
        slopes = terms / gap
        below = (slopes * upto).sum(axis=0)
        above = slopes.sum(axis=0) - below
        p, q = gap[first, own], gap[second, own]
        a, b = (p + q) * value - p * q * (below + above), p * q * value
        c = value - p * below - q * above
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4.0 * b * c, 0.0))
            move = np.where(a <= 0.0, (a - root) / (2.0 * c), 2.0 * b / (a + root))
            # The last root is right of both poles of its model: the other solution.
            move[-1] = (a[-1] + root[-1]) / (2.0 * c[-1]) if a[-1] >= 0.0 else 2.0 * b[-1] / (a[-1] - root[-1])
            there = step_at + move
            inside = (there > low) & (there < high) & (round_ < 40)
        step_at = np.where(done, step_at, np.where(inside, there, (low + high) / 2.0))
    return poles[nearer] + step_at, shifted - step_at[None, :]


def _rotate_equal(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, live: np.ndarray, tolerance: float) -> None:
    """Of live neighbours with almost equal eigenvalues, the lower one's z becomes zero by a rotation of the pair; in place."""
    low = -1
    for high in np.flatnonzero(live).tolist():
        if low >= 0:
            length = float(np.hypot(z[low], z[high]))
            c, s = z[high] / length, z[low] / length
            if abs((values[high] - values[low]) * c * s) <= tolerance:
                z[low], z[high] = 0.0, length
                live[low] = False
                vectors[:, [low, high]] = vectors[:, [low, high]] @ np.array([[c, s], [-s, c]])
                a, b = values[low], values[high]
                values[low], values[high] = a * c * c + b * s * s, a * s * s + b * c * c
        low = high


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors of ``vectors diag(values) vectors^T + v v^T``."""
    z = v @ vectors
    norm = float(np.sqrt(z @ z))
    tolerance = 8.0 * _EPS * max(float(values[-1]), norm * norm)
    live = np.abs(z) * norm > tolerance
    if not live.any():
        return values, vectors
    values, vectors = values.copy(), vectors.copy()
    d, y = values[live], z[live]
    if len(d) > 1 and ((d[1:] - d[:-1]) * np.abs(y[1:] * y[:-1]) <= tolerance * (y[1:] ** 2 + y[:-1] ** 2)).any():
        _rotate_equal(values, vectors, z, live, tolerance)
        at = np.flatnonzero(live)
        at = at[np.argsort(values[at], kind="stable")]
    else:
        at = np.flatnonzero(live)
    poles, y = values[at], z[at]
    roots, away = secular_roots(poles, y)
    between = poles[None, :] - poles[:, None]
    np.fill_diagonal(between, 1.0)
    # The z for which these roots are exact: a product over the roots, taken pairwise with the poles so that nothing overflows.
    y = np.copysign(np.sqrt(np.abs(np.prod(-away / between, axis=1))), y)
    turn = y[:, None] / away
    turn /= np.sqrt((turn * turn).sum(axis=0))
    values[at], vectors[:, at] = roots, vectors[:, at] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


# --- spectra ------------------------------------------------------------------------------

@dataclass
class Spectrum:
    """Number of vectors, their sums (whole numbers), their mean, and the eigenpairs of their scatter matrix."""

    n: int
    sums: np.ndarray
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(0, np.zeros(size, dtype=object), np.zeros(size), np.zeros(size), np.eye(size))

    def add(self, v: np.ndarray) -> None:
        """One more vector (its sums are added by the caller)."""
        away = v - self.mean
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, away * np.sqrt(self.n / (self.n + 1.0)))
        self.n += 1
        self.mean = self.mean + away / self.n

    def merge(self, other: Spectrum) -> Spectrum:
        large, small = (self, other) if self.n >= other.n else (other, self)
        n = large.n + small.n
        if small.n:
            away = small.mean - large.mean
            values, vectors = large.values, large.vectors
            for j in np.flatnonzero(small.values > 0.0):
                values, vectors = rank_one(values, vectors, np.sqrt(small.values[j]) * small.vectors[:, j])
            values, vectors = rank_one(values, vectors, away * np.sqrt(large.n * (small.n / n)))
            return Spectrum(n, large.sums + small.sums, large.mean + away * (small.n / n), values, vectors)
        return large


@dataclass
class Moments:
    """Number of points, their mean, and the sum of the outer products of what is left after the mean is taken away."""

    n: int
    mean: np.ndarray
    scatter: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray) -> Moments:
        mean = points.mean(axis=0)
        centred = points - mean
        return cls(len(points), mean, centred.T @ centred)

    def merge(self, other: Moments) -> Moments:
        n, away = self.n + other.n, other.mean - self.mean
        return Moments(n, self.mean + away * (other.n / n), self.scatter + other.scatter + np.outer(away, away) * (self.n * (other.n / n)))


_SPECTRUM = "part long, size int, n long, sums array<decimal(38,0)>, mean array<double>, values array<double>, vectors array<double>"
_MOMENTS = "part long, size int, n long, mean array<double>, scatter array<double>"


def _list(values, kind: pa.DataType) -> pa.Array:
    return pa.array([values], pa.list_(kind))


def _write_spectrum(part: int, size: int, s: Spectrum) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([part], pa.int64()), pa.array([size], pa.int32()), pa.array([s.n], pa.int64()),
        _list([Decimal(int(v)) for v in s.sums], pa.decimal128(38, 0)), *(_list(a.ravel(), pa.float64()) for a in (s.mean, s.values, s.vectors))],
        names=["part", "size", "n", "sums", "mean", "values", "vectors"])


def _read_spectrum(row: dict) -> Spectrum:
    size = row["size"]
    return Spectrum(row["n"], np.array([int(v) for v in row["sums"]], dtype=object), np.array(row["mean"]), np.array(row["values"]),
                    np.array(row["vectors"]).reshape(size, size))


def _write_moments(part: int, size: int, m: Moments) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([part], pa.int64()), pa.array([size], pa.int32()), pa.array([m.n], pa.int64()),
        _list(m.mean, pa.float64()), _list(m.scatter.ravel(), pa.float64())], names=["part", "size", "n", "mean", "scatter"])


def _read_moments(row: dict) -> Moments:
    width = len(row["mean"])
    return Moments(row["n"], np.array(row["mean"]), np.array(row["scatter"]).reshape(width, width))


def _combined(states: DataFrame, schema: str, read: Callable, write: Callable, label: str) -> dict:
    """The states of all partitions merged into one for each vector length, ``FAN_IN`` of them in a task at a time."""
    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["part"])
        state = read(rows[0])
        for row in rows[1:]:
            state = state.merge(read(row))
        return pa.Table.from_batches([write(rows[0]["part"] // FAN_IN, rows[0]["size"], state)])

    states = materialize(states, label)
    while states.agg(F.max("part")).first()[0]:
        states = materialize(states.groupBy("size", F.floor(F.col("part") / FAN_IN)).applyInArrow(merge, schema), label)
    return {r["size"]: read(r.asDict()) for r in states.collect()}  # one row per vector length


def spectra(rows: DataFrame) -> dict[int, Spectrum]:
    """The spectrum of all vectors of each length, out of ``rows`` (x, size)."""
    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Spectrum] = {}
        for whole in batches:
            for size, batch in by_size(whole):
                state = seen.setdefault(size, Spectrum.empty(size))
                x = matrix(batch.column("x"), size)
                state.sums = state.sums + (x >> 31).sum(axis=0).astype(object) * (1 << 31) + (x & ((1 << 31) - 1)).sum(axis=0).astype(object)
                for v in x.astype(np.float64):
                    state.add(v)
        for size, state in seen.items():
            yield _write_spectrum(TaskContext.get().partitionId(), size, state)

    return _combined(rows.where("size > 0").select("x", "size").mapInArrow(update, _SPECTRUM), _SPECTRUM, _read_spectrum, _write_spectrum, "spectra")


# --- refinement and result ----------------------------------------------------------------

def _spread(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, exactly: in longs where they cannot overflow."""
    most = max(int(np.abs(x).max(initial=0)), *(abs(int(s)) // max(n, 1) + 1 for s in sums))
    if n * most < 1 << 61:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


@dataclass
class Whitening:
    """What the vectors of one length need: number and sums, components (dimensions x k) and their eigenvalues, trace of the covariance.

    ``drift`` is the largest entry off the diagonal in the covariance of projections on the incremental eigenvectors, over the trace.
    """

    n: int
    sums: np.ndarray
    components: np.ndarray
    values: np.ndarray
    trace: float
    drift: float

    def solid(self) -> np.ndarray:
        """Which components have an eigenvalue that is not zero within rounding."""
        return self.values > 16.0 * _EPS * len(self.sums) * self.trace

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n * x - S, the same over n as doubles)."""
        spread = _spread(x, self.n, self.sums)
        return spread, (spread / self.n).astype(np.float64)

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        """One column per component, NaN where it is not solid."""
        scale = np.sqrt(np.where(self.solid(), self.values, np.nan))
        return centred @ self.components / scale


def _projected(rows: DataFrame, project: dict[int, Callable[[np.ndarray], np.ndarray]], label: str) -> dict[int, Moments]:
    """Moments over all rows of what ``project`` makes of the vectors of a length."""
    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Moments] = {}
        for whole in batches:
            for size, batch in by_size(whole):
                if size in project:
                    found = Moments.of(project[size](matrix(batch.column("x"), size)))
                    seen[size] = seen[size].merge(found) if size in seen else found
        for size, state in seen.items():
            yield _write_moments(TaskContext.get().partitionId(), size, state)

    return _combined(rows.select("x", "size").mapInArrow(update, _MOMENTS), _MOMENTS, _read_moments, _write_moments, label)


def refined(rows: DataFrame, found: dict[int, Spectrum], components: int = COMPONENTS) -> dict[int, Whitening]:
    """Rayleigh-Ritz over all rows, in the space of the incremental eigenvectors."""
    plain = {s: Whitening(f.n, f.sums, np.linalg.qr(f.vectors[:, ::-1])[0], np.ones(s), 1.0, 0.0) for s, f in found.items()}
    moments = _projected(rows, {s: (lambda x, w=w: w.centred(x)[1] @ w.components) for s, w in plain.items()}, "ritz")
    out = {}
    for size, m in moments.items():
        covariance, w = m.scatter / m.n, plain[size]
        values, turn = np.linalg.eigh((covariance + covariance.T) / 2.0)
        chosen = (w.components @ turn[:, ::-1])[:, :components]
        chosen /= np.sqrt((chosen * chosen).sum(axis=0))
        chosen *= np.where(chosen[np.abs(chosen).argmax(axis=0), np.arange(chosen.shape[1])] < 0.0, -1.0, 1.0)
        trace = float(np.trace(covariance))
        off = covariance - np.diag(np.diag(covariance))
        out[size] = Whitening(w.n, w.sums, chosen, np.maximum(values[::-1][:components], 0.0), trace, float(np.abs(off).max()) / trace if trace else 0.0)
    return out


def fit(rows: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """The whitening of each vector length, fitted on all ``rows`` (x, size)."""
    return refined(rows, spectra(rows), components)


def identity_errors(rows: DataFrame, models: dict[int, Whitening]) -> dict[int, float | None]:
    """How far the covariance of the whitened rows is from the identity, at most, over all rows."""
    solid = {s: np.flatnonzero(m.solid()) for s, m in models.items()}
    project = {s: (lambda x, m=m, at=solid[s]: m.whiten(m.centred(x)[1])[:, at]) for s, m in models.items() if len(solid[s])}
    found = _projected(rows, project, "whitened") if project else {}
    return {s: float(np.abs(found[s].scatter / found[s].n - np.eye(len(solid[s]))).max()) if s in found else None for s in models}


def transformed(rows: DataFrame, models: dict[int, Whitening]) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row (vec_id, x, size) and component."""
    errors = identity_errors(rows, models)

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for size, batch in by_size(whole):
                if size not in models:
                    continue
                m, count = models[size], len(batch)
                spread, centred = m.centred(matrix(batch.column("x"), size))
                if spread.dtype != object and size * (2 * int(np.abs(spread).max(initial=0))) ** 2 >= 1 << 63:
                    spread = spread.astype(object)
                k = len(m.values)
                each = pa.array(np.repeat(np.arange(count), k))
                explained = [float(e) / m.trace if m.trace else None for e in m.values]
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                    pa.array(np.full(count * k, m.n, dtype=np.int64)), fits_long((spread * spread).sum(axis=1)).take(each),
                    pa.array(m.whiten(centred).ravel(), from_pandas=True),  # NaN is null
                    pa.array(explained * count, pa.float64()), pa.array([errors[size]] * (count * k), pa.float64())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x", "size").mapInArrow(
        transform, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whitened(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """Every valid row of ``vectors`` (vec_id, embedding) on each of the leading components; see ``transformed`` for the columns."""
    rows = materialize(whole_vectors(vectors, scale, shift), "whole-vectors")
    return transformed(rows, fit(rows, components))
