"""Whitening of embeddings by an incremental eigendecomposition.

Vectors are rounded down to whole 256ths, and the model is fitted to the different ones. Every partition keeps number,
mean and the eigendecomposition of its scatter matrix, and takes vector after vector as a centred rank-one update:
in the basis of the eigenvectors the updated matrix is a diagonal plus one outer product, whose eigenvalues are the
roots of a secular equation between the old ones. Directions that the vector does not touch, and all but one direction
of equal eigenvalues, are deflated. Spectra are combined by further rank-one updates, level by level. A distributed
Rayleigh-Ritz step in the basis found brings the components to double precision.
"""
from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import empty, stage

SCALE = 256
EPSILON = np.finfo(float).eps
FAN_IN = 16  # spectra that one task combines
REFINEMENTS = 4  # Rayleigh-Ritz steps at most
SETTLED = 1e-13  # largest share of a mixed term of two components after which no further step is taken
FLAT = 1e-12  # share of the whole variance below which a direction counts as constant
SAFE = 2**62


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + rho z z', d strictly rising, z without zeros, rho > 0.

    Returns the nearest pole of each root and the root's distance from it: the differences of roots and poles, which
    the eigenvectors are made of, keep all their digits in this form. Each step puts a rational function with the two
    poles around the root through value and slope on either side, and falls back to halving.
    """
    k = len(d)
    z2 = rho * z * z
    width = np.append(np.diff(d), z2.sum())
    lower = np.arange(k)
    upper = np.minimum(lower + 1, k - 1)
    middle = 1 + (z2[:, None] / ((d[:, None] - d) - width / 2)).sum(0)
    right = middle < 0
    right[-1] = False
    origin = np.where(right, upper, lower)
    poles = d[:, None] - d[origin]
    low = np.where(right, -width / 2, 0.0)
    high = np.where(right, 0.0, np.where(lower == k - 1, width, width / 2))
    at = (low + high) / 2
    left = np.tri(k, dtype=bool).T  # poles up to the root's own
    u, v = poles[lower, lower], poles[upper, lower]
    with np.errstate(all="ignore"):
        for _ in range(100):
            gap = poles - at
            terms = z2[:, None] / gap
            value = 1 + terms.sum(0)
            open_ = np.abs(value) > 4 * k * EPSILON * (1 + np.abs(terms).sum(0))
            low, high = np.where(value < 0, at, low), np.where(value < 0, high, at)
            open_ &= high - low > 2 * EPSILON * np.maximum(np.abs(low), np.abs(high))
            if not open_.any():
                break
            slopes = terms / gap
            slope = slopes.sum(0)
            below = (slopes * left).sum(0)
            above = slope - below
            near, far = u - at, v - at
            b, e = below * near**2, above * far**2
            # The last root has poles on one side only.
            e[-1] = 0.0
            c = value - below * near - above * far
            c[-1] = value[-1] - below[-1] * near[-1]
            # c + b/(u-x) + e/(v-x) = 0
            half = (c * (u + v) + b + e) / 2
            rest = c * u * v + b * v + e * u
            root = np.sqrt(np.maximum(half * half - c * rest, 0.0))
            one = np.where(half >= 0, half + root, half - root)
            first, second = one / c, rest / one
            first[-1] = second[-1] = u[-1] + b[-1] / c[-1]
            guess = np.where((first > low) & (first < high), first, second)
            good = np.isfinite(guess) & (guess > low) & (guess < high)
            at = np.where(open_, np.where(good, guess, (low + high) / 2), at)
    return origin, at


@dataclass
class Spectrum:
    """Number, mean and scatter matrix of vectors, the matrix as rising eigenvalues and columns of eigenvectors."""

    count: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def nothing(cls, size: int) -> Spectrum:
        return cls(0, np.zeros(size), np.zeros(size), np.eye(size))

    def add(self, vector: np.ndarray) -> None:
        """One more vector: a rank-one update with its distance from the mean so far."""
        away = vector - self.mean
        self.count += 1
        self.mean = self.mean + away / self.count
        if self.count > 1:
            self.update(np.sqrt((self.count - 1) / self.count) * away)

    def merge(self, other: Spectrum) -> None:
        """The vectors of another spectrum, too: its directions and the distance of the means, as rank-one updates."""
        if not other.count:
            return
        away, total = other.mean - self.mean, self.count + other.count
        if self.count:
            for value, vector in zip(other.values, other.vectors.T):
                if value > 0:
                    self.update(np.sqrt(value) * vector)
            self.update(np.sqrt(self.count / total * other.count) * away)
            self.mean = self.mean + away * (other.count / total)
        else:
            self.mean, self.values, self.vectors = other.mean, other.values, other.vectors
        self.count = total

    def update(self, vector: np.ndarray) -> None:
        """Add the outer product of a vector to the scatter matrix."""
        z = self.vectors.T @ vector
        rho = float(z @ z)
        if not rho > 0:
            return
        z /= np.sqrt(rho)
        d, q = self.values, self.vectors
        small = 8 * EPSILON * max(d[-1], rho)
        active = np.flatnonzero(rho * np.abs(z) > small)
        if not len(active):
            active = np.array([int(np.abs(z).argmax())])
        # Of equal eigenvalues one direction takes the whole vector, by a reflection; the others are deflated.
        close = np.diff(d[active]) <= small
        if close.any():
            q, keep = q.copy(), np.ones(len(active), bool)
            starts = np.flatnonzero(np.concatenate([[True], ~close]))
            for start, end in zip(starts, np.append(starts[1:], len(active))):
                if end - start > 1:
                    own = active[start:end]
                    part = z[own]
                    length = np.sqrt(part @ part)
                    mirror = part.copy()
                    mirror[-1] += length if part[-1] >= 0 else -length
                    q[:, own] -= np.outer(q[:, own] @ mirror, 2 / (mirror @ mirror) * mirror)
                    z[own[:-1]], z[own[-1]] = 0.0, -length if part[-1] >= 0 else length
                    keep[start : end - 1] = False
            active = active[keep]
        poles, weights = d[active], z[active]
        if len(active) == 1:
            found, basis = poles + rho * weights**2, q[:, active]
        else:
            origin, at = secular_roots(poles, weights, rho)
            # away[i, j]: root j less pole i.
            away = at - (poles[:, None] - poles[origin])
            between = poles - poles[:, None]
            np.fill_diagonal(between, 1.0)
            # Weights for which the roots found are exact keep the eigenvectors orthogonal.
            exact = np.sqrt(np.abs(np.prod(away / between, axis=1))) * np.sign(weights)
            turn = exact[:, None] / away
            turn /= np.sqrt((turn * turn).sum(0))
            found, basis = poles[origin] + at, q[:, active] @ turn
        values, vectors = d.copy(), q.copy()
        values[active], vectors[:, active] = found, basis
        order = np.argsort(values, kind="stable")
        self.values, self.vectors = values[order], vectors[:, order]


SPECTRUM = "part long, n long, mean array<double>, eigenvalues array<double>, eigenvectors array<double>"


def _packed(part: int, spectrum: Spectrum) -> dict:
    return {
        "part": part, "n": spectrum.count, "mean": spectrum.mean.tolist(), "eigenvalues": spectrum.values.tolist(),
        "eigenvectors": spectrum.vectors.reshape(-1).tolist(),
    }


def _unpacked(row) -> Spectrum:
    size = len(row["mean"])
    return Spectrum(row["n"], np.array(row["mean"]), np.array(row["eigenvalues"]), np.array(row["eigenvectors"]).reshape(size, size))


ARROW = pa.schema(
    [("part", pa.int64()), ("n", pa.int64()), ("mean", pa.list_(pa.float64())), ("eigenvalues", pa.list_(pa.float64())), ("eigenvectors", pa.list_(pa.float64()))]
)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """A list column whose rows all have ``size`` numbers, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def spectrum_of(points: DataFrame, size: int) -> Spectrum:
    """The spectrum of all rows of a frame with one column x of ``size`` numbers."""

    def gather(batches):
        spectrum = Spectrum.nothing(size)
        for batch in batches:
            for vector in _matrix(batch.column("x"), size).astype(float):
                spectrum.add(vector)
        if spectrum.count:
            yield pa.RecordBatch.from_pylist([_packed(TaskContext.get().partitionId(), spectrum)], schema=ARROW)

    def combine(key, table):
        rows = sorted(table.to_pylist(), key=lambda row: row["part"])
        total = Spectrum.nothing(size)
        for row in rows:
            total.merge(_unpacked(row))
        return pa.Table.from_pylist([_packed(key[0].as_py(), total)], schema=ARROW)

    parts = stage(points.mapInArrow(gather, SPECTRUM), "spectra")
    while parts.count() > 1:
        grouped = parts.groupBy(F.floor(F.col("part") / FAN_IN).alias("group"))
        parts = stage(grouped.applyInArrow(combine, SPECTRUM), "spectra")
    row = parts.first()
    return _unpacked(row) if row else Spectrum.nothing(size)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, exactly: as 64-bit numbers where they hold it, as Python's otherwise."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if n * most + max(map(abs, sums.tolist()), default=0) < SAFE:
        return x * n - sums.astype(np.int64)
    return x.astype(object) * n - sums


def products(points: DataFrame, basis: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """Covariance of all points in a basis: products of their centred coordinates, summed up where the points are."""
    size, width = basis.shape
    spark = points.sparkSession
    shared = spark.sparkContext.broadcast((basis, n, sums))

    def add(batches):
        basis, n, sums = shared.value
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                at = (centred(_matrix(batch.column("x"), size), n, sums) / n).astype(float) @ basis
                total += at.T @ at
        yield pa.RecordBatch.from_arrays([pa.array([total.reshape(-1)], pa.list_(pa.float64()))], ["total"])

    rows = points.mapInArrow(add, "total array<double>").select(F.posexplode("total").alias("at", "value"))
    found = np.zeros(width * width)
    for row in rows.groupBy("at").agg(F.sum("value").alias("value")).collect():  # width * width numbers
        found[row["at"]] = row["value"]
    return found.reshape(width, width) / n


@dataclass
class Whitening:
    """The fitted model: number and sums of the different vectors, components as columns, their variances and shares."""

    n: int
    sums: np.ndarray
    basis: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float


def rounded(vectors: DataFrame, vector_column: str = "embedding") -> DataFrame:
    """Rows whose vector has only finite entries, with x, its whole 256ths.

    Left out are null and empty vectors, those with null or non-finite entries, and those with an entry beyond 2**53 / 256,
    of which a double no longer holds whole parts. Vectors of another length than the commonest (of equally common ones the
    longest) cannot be compared with the others and are left out, too.
    """
    vector = F.col(f"`{vector_column}`")
    fits = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < 2.0**53 / SCALE))
    kept = vectors.where(vector.isNotNull() & (F.size(vector) > 0)).where(fits)
    lengths = kept.groupBy(F.size(vector).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = lengths["size"] if lengths else 0
    kept = kept.where(F.size(vector) == size)
    return kept.withColumn("x", F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long")))


def fit(points: DataFrame, components: int = 4) -> Whitening | None:
    """The model of the different vectors x among the rows of ``points``; None without rows.

    Fewer components come out where the vectors vary in fewer directions (a direction with less than a share of
    ``FLAT`` of all variance counts as constant), none where all are equal.
    """
    first = points.select("x").first()
    if first is None:
        return None
    size = len(first["x"])
    # Copies go on the map side, so a vector that a third of all rows hold is one row per task.
    different = stage(points.select("x").dropDuplicates(["x"]), "different-vectors")
    totals = different.select(F.posexplode("x").alias("at", "value")).groupBy("at")
    rows = totals.agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total"), F.count("*").alias("n")).collect()  # one for each dimension
    n, sums = rows[0]["n"], np.zeros(size, object)
    for row in rows:
        sums[row["at"]] = int(row["total"])
    spectrum = spectrum_of(different, size)
    basis = np.linalg.qr(spectrum.vectors[:, ::-1])[0]
    for _ in range(REFINEMENTS):
        found = products(different, basis, n, sums)
        whole = float(np.trace(found))
        values, turn = np.linalg.eigh((found + found.T) / 2)
        mixed = np.abs(found - np.diag(np.diag(found)))[:components].max(initial=0.0)
        basis = basis @ turn[:, ::-1]
        basis = np.linalg.qr(basis)[0]
        if mixed <= SETTLED * whole:
            break
    kept = basis[:, :components][:, values[::-1][:components] > FLAT * whole]
    if not kept.shape[1]:
        return Whitening(n, sums, kept, np.zeros(0), np.zeros(0), 0.0)
    last = products(different, kept, n, sums)
    variances = np.diag(last).copy()
    error = np.abs(last / np.sqrt(np.outer(variances, variances)) - np.eye(len(variances))).max()
    return Whitening(n, sums, kept, variances, variances / whole, float(error))


def whiten(points: DataFrame, model: Whitening | None, id_column: str = "vec_id") -> DataFrame:
    """Every row of ``points`` (with x) on every component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error.

    ``deviation`` is the sum of (n x - S)^2 over the dimensions, exact, as decimal(38,0). Rows that repeat an id or a vector
    each have their own rows; an id may be null. No rows without a model or without components.
    """
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None or not len(model.variances):
        return empty(points.sparkSession, schema)
    shared = points.sparkSession.sparkContext.broadcast(model)  # components times dimensions

    def project(batches):
        model = shared.value
        size, many = model.basis.shape
        for batch in batches:
            if not batch.num_rows:
                continue
            away = centred(_matrix(batch.column("x"), size), model.n, model.sums)
            most = int(np.abs(away).max(initial=0))
            if most * most * size < SAFE and away.dtype != object:
                squares = pa.array((away * away).sum(1)).cast(pa.decimal128(38, 0))
            else:
                squares = pa.array([Decimal(sum(value * value for value in map(int, row))) for row in away], pa.decimal128(38, 0))
            at = ((away / model.n).astype(float) @ model.basis) / np.sqrt(model.variances)
            rows = np.repeat(np.arange(len(at)), many)
            columns = [
                batch.column("vec_id").take(pa.array(rows)), pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(at))),
                pa.array(np.full(len(rows), model.n, np.int64)), squares.take(pa.array(rows)), pa.array(at.reshape(-1)),
                pa.array(np.tile(model.explained, len(at))), pa.array(np.full(len(rows), model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return points.selectExpr(f"cast(`{id_column}` as long) as vec_id", "x").mapInArrow(project, schema)
