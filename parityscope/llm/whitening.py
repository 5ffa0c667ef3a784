"""Embedding whitening by incremental eigendecomposition.

Each partition keeps the eigenvectors and eigenvalues of the scatter of its vectors about
their mean. A vector changes them by one rank: with ``z`` the vector's difference from the
mean in the eigenvectors' coordinates, the new eigenvalues are the roots of the secular
equation ``1 + sum(z_j**2 / (d_j - x)) = 0``, one between each two of the old ones.
Components that ``z`` does not reach are left as they are, and those of equal eigenvalues are
first reflected so that ``z`` reaches one of them (deflation). The vectors are rebuilt from
the ``z`` for which the roots found are exact, so they stay orthogonal.

Spectra of partitions are combined, a few at a time, by one such update for each
eigenvector of the other spectrum and one for the difference of both means. In the basis
found, the covariance of all vectors is summed once more, centred by exact integer sums,
and its own small eigenproblem refines the basis (Rayleigh-Ritz).

Only sums, spectra and matrices as large as the number of dimensions squared leave a task;
a partition may hold any share of the vectors.

Defined results: vectors that are null or hold null or non-finite components, or of
another length than most (of the shorter one, if several lengths are equally frequent),
take no part; a null id is kept; repeated rows count, and are returned, as often as they
occur; a component without variance has whitened value 0 and is left out of the identity
error; an empty table gives no rows; other columns are passed over. Deviations are exact,
as decimals; a table whose sums could exceed 62 bits ends with an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityscope.llm.shared import written
from parityscope.llm.vectors import as_integers, matrix, most_frequent_length

SCALE, SHIFT = 64, 1_000_000
#: Components returned at most.
COMPONENTS = 32
#: Spectra that one task combines.
COMBINED = 8
#: Eigenvalues below this share of the largest one count as none.
NO_VARIANCE = 1e-12
_ROWS = 4096
_EPS = np.finfo(float).eps


def secular_roots(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(w / (d - x))`` for ascending different ``d`` and positive ``w``, and
    the differences ``d[j] - root[i]``, which are exact to the last bits.

    Each root is sought as a distance from the nearer end of its interval. A step solves the
    equation with the poles of the interval's two ends in place of all on either side; a
    step that leaves the bracket halves it.
    """
    n = len(d)
    upper = np.append(d[1:], d[-1] + w.sum())
    half = (upper - d) / 2
    right = 1 + (w / (d - d[:, None] - half[:, None])).sum(1) < 0
    near_right = right.copy()
    near_right[-1] = False  # there is no pole above the last root
    origin = np.where(near_right, upper, d)
    delta = d - origin[:, None]
    low, high = np.where(near_right, -half, 0.0), np.where(near_right, 0.0, half)
    if right[-1]:
        low[-1], high[-1] = half[-1], 2 * half[-1]
    x = (low + high) / 2
    below = np.tril(np.ones((n, n)))
    own, following = np.arange(n), np.minimum(np.arange(n) + 1, n - 1)
    for _ in range(100):
        t = delta - x[:, None]
        q = w / t
        slope = q / t
        left_sum, right_sum = (q * below).sum(1), (q * (1 - below)).sum(1)
        left_slope, right_slope = (slope * below).sum(1), (slope * (1 - below)).sum(1)
        f = 1 + left_sum + right_sum
        done = np.abs(f) <= 4 * n * _EPS * (1 + np.abs(left_sum) + np.abs(right_sum))
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        done |= high - low <= 4 * _EPS * np.maximum(np.abs(low), np.abs(high))
        if done.all():
            break
        a_pole, b_pole = t[own, own], t[own, following]
        c = f - a_pole * left_slope - b_pole * right_slope
        a = (a_pole + b_pole) * f - a_pole * b_pole * (left_slope + right_slope)
        b = a_pole * b_pole * f
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            # One pole and a constant stand for all at the last root.
            step[-1] = a_pole[-1] + a_pole[-1] ** 2 * left_slope[-1] / (f[-1] - a_pole[-1] * left_slope[-1])
            new = x + step
        inside = np.isfinite(new) & (new > low) & (new < high)
        x = np.where(done, x, np.where(inside, new, (low + high) / 2))
    return origin + x, delta - x[:, None]


class Spectrum:
    """Eigenvalues (ascending) and eigenvectors (columns) of the scatter of ``n`` vectors
    about their mean."""

    def __init__(self, n: int, mean: np.ndarray, values: np.ndarray, vectors: np.ndarray) -> None:
        self.n, self.mean, self.values, self.vectors = n, mean, values, vectors

    @classmethod
    def empty(cls, dim: int) -> Spectrum:
        return cls(0, np.zeros(dim), np.zeros(dim), np.eye(dim))

    def add(self, x: np.ndarray) -> None:
        """One more vector: the scatter grows by ``n / (n + 1)`` times the square of its
        difference from the mean."""
        off = x - self.mean
        if self.n:
            self.update(np.sqrt(self.n / (self.n + 1)) * off)
        self.n += 1
        self.mean = self.mean + off / self.n

    def combine(self, other: Spectrum) -> None:
        """The vectors of another spectrum: one update for each of its eigenvectors."""
        if not other.n:
            return
        total = self.n + other.n
        off = other.mean - self.mean
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.update(np.sqrt(value) * vector)
        if self.n:
            self.update(np.sqrt(self.n * other.n / total) * off)
        self.mean = self.mean + off * (other.n / total)
        self.n = total

    def update(self, v: np.ndarray) -> None:
        """The scatter plus ``v v'``."""
        z = self.vectors.T @ v
        size = float(z @ z)
        d = self.values
        least = 8 * _EPS * max(float(np.abs(d).max(initial=0)), size)
        if not size or not len(d):
            return
        runs = np.flatnonzero(np.concatenate(([True], np.diff(d) > least, [True])))
        if len(runs) <= len(d):
            self._reflect(z, runs)
        reached = np.flatnonzero(np.sqrt(size) * np.abs(z) > least)
        if not len(reached):
            return
        z = z[reached]
        roots, off = secular_roots(d[reached], z * z)
        # The z for which these roots are exact (its squares are products of ratios).
        n = len(z)
        poles = d[reached]
        between = np.where(np.tri(n, n, 0, bool), np.append(poles[1:], 0)[:, None], poles[:, None]) - poles
        between[-1] = 1
        exact = np.sqrt(np.maximum((-off / between).prod(axis=0), 0)) * np.sign(z)
        turn = (exact / off).T
        turn /= np.sqrt((turn * turn).sum(0))
        values = d.copy()
        values[reached] = roots
        self.vectors[:, reached] = self.vectors[:, reached] @ turn
        order = np.argsort(values, kind="stable")
        self.values, self.vectors = values[order], self.vectors[:, order]

    def _reflect(self, z: np.ndarray, runs: np.ndarray) -> None:
        """Turn the eigenvectors of equal eigenvalues so that ``z`` reaches the last of them only."""
        for a, b in zip(runs, runs[1:], strict=False):
            length = np.sqrt(z[a:b] @ z[a:b])
            if b - a < 2 or not length:
                continue
            mirror = z[a:b].copy()
            to = -length if mirror[-1] > 0 else length
            mirror[-1] -= to
            mirror /= np.sqrt(mirror @ mirror)
            own = self.vectors[:, a:b]
            self.vectors[:, a:b] = own - 2 * np.outer(own @ mirror, mirror)
            z[a:b] = 0
            z[b - 1] = to


_SPECTRUM = "part long, n long, mean array<double>, `values` array<double>, vectors array<double>"


def _row(part: int, s: Spectrum) -> pa.RecordBatch:
    lists = [pa.array([v.ravel()], pa.list_(pa.float64())) for v in (s.mean, s.values, s.vectors)]
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([s.n], pa.int64()), *lists], ["part", "n", "mean", "values", "vectors"])


def _spectra(batch: pa.RecordBatch) -> Iterator[Spectrum]:
    for row in batch.to_pylist():
        yield Spectrum(row["n"], np.array(row["mean"]), np.array(row["values"]), np.array(row["vectors"]).reshape(len(row["mean"]), -1))


def _of_partition(dim: int):
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum = Spectrum.empty(dim)
        for batch in batches:
            for x in matrix(batch.column("vec")).astype(float):
                spectrum.add(x)
        if spectrum.n:
            yield _row(TaskContext.get().partitionId(), spectrum)

    return gather


def _combine(dim: int):
    def combine(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Spectrum.empty(dim)
        for batch in batches:
            for spectrum in _spectra(batch):
                total.combine(spectrum)
        yield _row(key[0].as_py(), total)

    return combine


def spectrum(rows: DataFrame, dim: int) -> Spectrum:
    """Of all vectors (``vec``): a spectrum for each partition, combined a few at a time."""
    parts = written(rows.select("vec").mapInArrow(_of_partition(dim), _SPECTRUM), "spectra")
    n = parts.agg(F.coalesce(F.max("part") + 1, F.lit(0))).first()[0]
    while n > 1:
        parts = parts.withColumn("part", F.floor(F.col("part") / COMBINED)).groupBy("part").applyInArrow(_combine(dim), _SPECTRUM)
        parts, n = written(parts, "spectra"), -(-n // COMBINED)
    return next(_spectra(parts.toArrow().combine_chunks().to_batches()[0]))


def _added(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = 0
    for batch in batches:
        total = total + matrix(batch.column("values")).sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([total], pa.list_(pa.float64()))], ["row", "values"])


def _products(rows: DataFrame, project, size: int) -> np.ndarray:
    """The sum, over all vectors, of the squares (outer products) of their projections."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                p = project(matrix(batch.column("vec").slice(a, _ROWS)))
                total += p.T @ p
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(list(total), pa.list_(pa.float64()))], ["row", "values"])

    kind = "row long, `values` array<double>"
    found = rows.select("vec").mapInArrow(multiply, kind).groupBy("row").applyInArrow(_added, kind).orderBy("row").toArrow()
    return matrix(found["values"])


class Sums:
    """Number, sums, least and largest components of all vectors, exact."""

    def __init__(self, rows: DataFrame, dim: int) -> None:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, total, low, high = 0, np.zeros(dim, np.int64), np.full(dim, 2**62), np.full(dim, -(2**62))
            for batch in batches:
                if batch.num_rows:
                    x = matrix(batch.column("vec"))
                    n, total = n + len(x), total + x.sum(axis=0)
                    low, high = np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dim)), pa.array(np.full(dim, n)), pa.array(total), pa.array(low), pa.array(high)],
                ["dim", "n", "total", "low", "high"],
            )

        most = rows.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform("vec", F.abs)))).first()
        if 4 * most[0] * max(most[1] or 0, 1) >= 2**62:
            raise OverflowError("sums of these vectors may exceed 62 bits")
        found = rows.select("vec").mapInArrow(add, "dim long, n long, total long, low long, high long").groupBy("dim")
        found = found.agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"))
        found = found.orderBy("dim").toArrow()
        self.n, self.total = most[0], found["total"].to_numpy()
        #: The largest deviation ``n * x - total`` of any component.
        self.largest = max(int(np.abs(self.n * found[c].to_numpy() - self.total).max(initial=0)) for c in ("low", "high"))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id``, ``component`` (from 1, by falling variance), ``n``, ``deviation``, ``whitened``,
    ``explained`` and ``identity_error`` of every usable vector and component."""
    spark = vectors.sparkSession
    rows = as_integers(vectors, SCALE, SHIFT)
    dim = most_frequent_length(rows)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if not dim:
        kinds = ("long", "int", "long", "decimal(38,0)", "double", "double", "double")
        return spark.createDataFrame([], ", ".join(map(" ".join, zip(names, kinds, strict=True))))
    rows = written(rows.filter(F.size("vec") == dim), "integers")
    sums = Sums(rows, dim)
    n, total = sums.n, sums.total

    def centred(x: np.ndarray) -> np.ndarray:
        return (n * x - total) / n

    basis = np.linalg.qr(spectrum(rows, dim).vectors)[0]
    values, turn = np.linalg.eigh(_products(rows, lambda x: centred(x) @ basis, dim) / n)
    trace = float(values.sum())
    values, axes = values[::-1][:components], (basis @ turn)[:, ::-1][:, :components]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    varied = values > NO_VARIANCE * max(values[0], 0)
    scaled = np.where(varied, axes / np.sqrt(np.where(varied, values, 1)), 0)
    explained = np.where(varied, values, 0) / (trace or 1)
    covariance = _products(rows, lambda x: centred(x) @ scaled, len(values)) / n
    off = np.abs(covariance - np.eye(len(values)))[np.ix_(varied, varied)]
    error = float(off.max(initial=0))
    narrow = dim * sums.largest**2 < 2**63

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, _ROWS):
                part = batch.slice(a, _ROWS)
                x = matrix(part.column("vec"))
                off = n * x - total
                square = (off**2).sum(axis=1) if narrow else [str(sum(int(v) ** 2 for v in row)) for row in off]
                which = np.repeat(np.arange(len(x)), len(values))
                numbers = np.tile(np.arange(len(values)), len(x))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("vec_id").take(pa.array(which)),
                        pa.array((numbers + 1).astype(np.int32)),
                        pa.array(np.full(len(which), n)),
                        pa.array(square).take(pa.array(which)),
                        pa.array((centred(x) @ scaled).ravel()),
                        pa.array(explained[numbers]),
                        pa.array(np.full(len(which), error)),
                    ],
                    names,
                )

    square = "long" if narrow else "string"
    kind = f"vec_id long, component int, n long, deviation {square}, whitened double, explained double, identity_error double"
    return rows.mapInArrow(project, kind).withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))
