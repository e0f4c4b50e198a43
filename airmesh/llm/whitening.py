"""Whitening of embeddings by eigenvectors from contour integrals (FEAST).

Vectors become whole numbers x = floor(64 * c) + 1000000.  The covariance of
the distinct vectors is taken in two passes (sums, then centred products), both
folded in tasks and added by a shuffle.  Its leading components come from it in
these steps, for a matrix of ``dimensions`` squared numbers:

* inertia: a symmetric elimination of V - t counts the eigenvalues above t, so
  bisection finds where the largest lie, and parts their range midway between
  neighbours into intervals of a few eigenvalues each;
* quadrature: for each interval, Gauss-Legendre nodes z on the upper half of
  the circle over it stand for the contour integral of the resolvent.  The
  complex solves (z - V)^-1 Y of all intervals and nodes are rows of one table
  that Spark's tasks solve; their weighted sum projects Y onto the interval's
  eigenvectors;
* Rayleigh-Ritz: within the projected subspace, the reduced problem's pairs
  inside the interval are its eigenpairs; Y becomes the projected subspace and
  the round is repeated until they stand still;
* an interval is done when its pairs are exact to rounding and as many as the
  inertia counted, so none is missed.  A last Rayleigh-Ritz over all intervals
  makes the components orthogonal to each other to rounding.

Rows are then projected where they lie; the components, ``LEADING`` times
``dimensions`` numbers, are broadcast.

Defined results: rows whose vector is null, empty or holds a null, NaN or
infinite entry go.  If vectors differ in length, the length of most rows
counts (of equal ones the larger), and rows of others go.  Components whose
eigenvalue is 0 within rounding can't be whitened and are left out, so fewer
distinct vectors or dimensions than ``LEADING`` give fewer components, and a
single distinct vector none.  Equal eigenvalues' components are any orthonormal
choice.  A deviation that passes 64 bits is null.  Repeated vectors count once
in the fit and each keep their rows; null ids stay; other columns are left out;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, map_rows, stored

#: How entries become whole numbers.
SCALE = 64
SHIFT = 1_000_000
LEADING = 16

#: Eigenvalues that an interval holds at most, unless they are equal.
PER_INTERVAL = 4
#: Quadrature nodes on a half circle, and rounds at most.
NODES = 8
ROUNDS = 20
#: A pair is exact when its residual is below this, relative to the largest eigenvalue.
EXACT = 1e-13
#: Eigenvalues below this, relative to the largest, are 0 within rounding.
NOTHING = 1e-12
SEED = 20_013


# ------------------------------------------------------------ the matrix


def count_above(matrix: np.ndarray, value: float) -> int:
    """Eigenvalues of a symmetric matrix above ``value``: positive pivots of its elimination.

    Bunch and Kaufman's pivots of one or two rows keep the elimination stable;
    a pivot of two rows has one eigenvalue of either sign.
    """
    a = matrix - value * np.eye(len(matrix))
    above = 0
    while len(a):
        column = np.abs(a[1:, 0])
        largest = float(column.max(initial=0.0))
        size = 1
        if abs(a[0, 0]) < 0.6403882032022076 * largest:  # (1 + sqrt(17)) / 8
            other = int(column.argmax()) + 1
            row = float(np.abs(np.delete(a[other], other)).max())
            if abs(a[0, 0]) * row >= 0.6403882032022076 * largest ** 2:
                other = 0
            elif abs(a[other, other]) >= 0.6403882032022076 * row:
                order = [other, *(i for i in range(len(a)) if i != other)]
                a = a[np.ix_(order, order)]
            else:
                order = [0, other, *(i for i in range(1, len(a)) if i != other)]
                a, size = a[np.ix_(order, order)], 2
        if size == 2:
            above += 1  # |off-diagonal| outweighs the diagonal: one eigenvalue of either sign
            part = a[2:, :2]
            a = a[2:, 2:] - part @ np.linalg.solve(a[:2, :2], part.T)
        else:
            pivot = float(a[0, 0])
            above += pivot > 0
            part = a[1:, 0]
            a = a[1:, 1:] - np.outer(part, part) / pivot if pivot else a[1:, 1:]
        a = (a + a.T) / 2
    return above


def largest_values(matrix: np.ndarray, top: float, most: int) -> Iterator[tuple[int, float]]:
    """(k, value) of the ``most`` largest eigenvalues that aren't nothing, falling, by bisection on inertia counts."""
    counts = {NOTHING * top: count_above(matrix, NOTHING * top), top: 0}
    for k in range(1, min(most, counts[NOTHING * top]) + 1):
        low = max(t for t, n in counts.items() if n >= k)
        high = min(t for t, n in counts.items() if n < k)
        while high - low > 1e-13 * top:
            middle = (low + high) / 2
            counts[middle] = n = count_above(matrix, middle)
            low, high = (middle, high) if n >= k else (low, middle)
        yield k, low


def intervals(matrix: np.ndarray, leading: int) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside) over the ``leading`` largest eigenvalues at least, falling.

    Their ends lie midway between neighbouring eigenvalues; ones that are too
    close to be told apart stay in one interval.
    """
    top = float(np.abs(matrix).sum(1).max()) * (1 + 1e-9)  # Gershgorin
    apart = 1e-9 * top
    values: list[float] = []
    for k, value in largest_values(matrix, top, len(matrix)):
        values.append(value)
        if k > leading and values[-2] - value > apart:
            break
    rest = values.pop() if len(values) > leading and values[-2] - values[-1] > apart else 0.0
    below = [*values[1:], rest]
    out, start, high = [], 0, None
    while start < len(values):
        # the widest gap that follows within the next few eigenvalues, else the first gap after them
        ends = [i for i in range(start, len(values)) if values[i] - below[i] > apart or i == len(values) - 1]
        near = [i for i in ends if i < start + PER_INTERVAL]
        end = max(near, key=lambda i: values[i] - below[i]) if near and near[-1] < len(values) - 1 else (near or ends)[-1 if near else 0]
        low = (values[end] + below[end]) / 2
        if high is None:
            high = values[0] + (values[0] - low) / 4
        out.append((low, high, end + 1 - start))
        start, high = end + 1, low
    return out


def quadrature(low: float, high: float) -> tuple[np.ndarray, np.ndarray]:
    """Nodes on the upper half circle over an interval, and their weights."""
    x, w = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(1j * np.pi * (1 - x) / 2)
    radius = (high - low) / 2
    return (low + high) / 2 + radius * turn, w / 2 * radius * turn


def _solved(spark: SparkSession, matrix: np.ndarray, work: dict[int, tuple[float, float]], starts: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """The projection of each interval's start onto the eigenvectors inside, its nodes solved in tasks."""
    rows = [(i, float(z.real), float(z.imag), float(w.real), float(w.imag)) for i, (a, b) in work.items() for z, w in zip(*quadrature(a, b), strict=True)]
    known = spark.sparkContext.broadcast((matrix, starts))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, begun = known.value
        for batch in batches:
            for r in batch.to_pylist():
                z, w = complex(r["re"], r["im"]), complex(r["wre"], r["wim"])
                y = begun[r["interval"]]
                part = (w * np.linalg.solve(z * np.eye(len(own)) - own, y.astype(complex))).real
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["interval"]], pa.int32()), pa.array([r["re"]]), pa.array([part.ravel()], pa.list_(pa.float64()))], names=["interval", "re", "part"])

    table = spark.createDataFrame(rows, "interval int, re double, im double, wre double, wim double").repartition(min(len(rows), 64), "interval", "re")
    out = {i: np.zeros_like(y) for i, y in starts.items()}
    # dimensions times a few columns for each node: no more than the matrix itself
    for r in sorted(map_rows(table, solve, "interval int, re double, part array<double>").collect(), key=lambda r: (r["interval"], r["re"])):
        out[r["interval"]] += np.array(r["part"]).reshape(out[r["interval"]].shape)
    known.destroy()
    return out


def leading_pairs(spark: SparkSession, matrix: np.ndarray, leading: int = LEADING) -> tuple[np.ndarray, np.ndarray]:
    """The ``leading`` largest eigenvalues of a covariance, falling, and unit eigenvectors as rows."""
    none = np.zeros(0), np.zeros((0, len(matrix)))
    if not len(matrix) or not np.abs(matrix).max():
        return none
    scale = float(np.abs(matrix).sum(1).max())
    parts = intervals(matrix, leading)
    random = np.random.default_rng(SEED)
    # half as many columns more than eigenvalues, so that the projected subspace holds them all
    starts = {i: random.standard_normal((len(matrix), min(len(matrix), n + max(2, n // 2)))) for i, (_, _, n) in enumerate(parts)}
    done: dict[int, np.ndarray] = {}
    for turn in range(ROUNDS):
        if not starts:
            break
        for i, projected in _solved(spark, matrix, {i: parts[i][:2] for i in starts}, starts).items():
            basis = _basis(projected)
            values, inner = np.linalg.eigh(basis.T @ matrix @ basis)
            vectors = basis @ inner
            low, high, n = parts[i]
            inside = (values > low) & (values < high)
            rest = np.linalg.norm(matrix @ vectors[:, inside] - vectors[:, inside] * values[inside], axis=0)
            if inside.sum() == n and rest.max() <= EXACT * scale * len(matrix):
                done[i] = vectors[:, inside]
                del starts[i]
            else:  # go on from the subspace; with more columns where it stands still
                more = min(len(matrix), 2 * vectors.shape[1] if turn % 4 == 3 else starts[i].shape[1])
                starts[i] = np.concatenate([vectors, random.standard_normal((len(matrix), max(0, more - vectors.shape[1])))], 1)
    if starts:
        raise RuntimeError(f"no exact eigenpairs in {len(starts)} of {len(parts)} intervals after {ROUNDS} rounds")
    if not done:
        return none
    basis = np.linalg.qr(np.concatenate([done[i] for i in sorted(done)], 1))[0]
    values, inner = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-values, kind="stable")[:leading]
    return values[order], (basis @ inner[:, order]).T


def _basis(columns: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the span of ``columns``, without directions lost in rounding."""
    left, sizes, _ = np.linalg.svd(columns, full_matrices=False)
    return left[:, sizes > 1e-14 * sizes[0]] if len(sizes) and sizes[0] else left


# -------------------------------------------------------------- the rows


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x array<long>) of the rows with a usable vector."""
    entry = F.col("embedding")
    sound = entry.isNotNull() & (F.size(entry) > 0) & ~F.exists(entry, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    scaled = F.transform(entry, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)
    return embeddings.filter(sound).select("vec_id", scaled.alias("x"))


def usual_length(vectors: DataFrame) -> int:
    """The length of most vectors, of equally usual ones the larger; 0 without rows."""
    row = vectors.groupBy(F.size("x").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    return row["d"] if row else 0


def _rows_of(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def added(vectors: DataFrame, dimensions: int, fold) -> np.ndarray:
    """The sum over all rows of ``fold(rows)``, an array: folded in tasks, cells added by a shuffle."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                own = fold(_rows_of(batch.slice(start, 4096), dimensions))
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["cell", "value"])

    shape = fold(np.zeros((0, dimensions), np.int64))
    kind = "long" if shape.dtype == np.int64 else "double"
    out = np.zeros(shape.size, shape.dtype)
    for row in map_rows(vectors.select("x"), partial, f"cell int, value {kind}").groupBy("cell").agg(F.sum("value").alias("value")).collect():
        out[row["cell"]] = row["value"]
    return out.reshape(shape.shape)


class Fit:
    """What whitening needs: count, sums, eigenvalues, components as rows, trace and identity error."""

    def __init__(self, n: int, sums: np.ndarray, values: np.ndarray, components: np.ndarray, trace: float):
        self.n, self.sums, self.values, self.components, self.trace = n, sums, values, components, trace
        self.identity_error = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n; whole parts are taken off first, so nothing is lost to the shift."""
        whole = self.sums // max(self.n, 1)
        return (x - whole).astype(np.float64) - (self.sums - whole * self.n) / max(self.n, 1)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.values)[:, None]).T

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sums over dimensions of (n * x - S) ** 2, exact; null beyond 64 bits."""
        far = x - self.sums // max(self.n, 1)
        if (float(np.abs(far).max(initial=0)) + 1) ** 2 * float(self.n) ** 2 * x.shape[1] < 2 ** 62:
            return ((self.n * far - (self.sums - self.sums // self.n * self.n)) ** 2).sum(1).tolist()
        exact = [sum((self.n * int(c) - int(s)) ** 2 for c, s in zip(row, self.sums, strict=True)) for row in x]
        return [v if v < 2 ** 63 else None for v in exact]


def fit_whitening(vectors: DataFrame, dimensions: int, leading: int = LEADING) -> Fit:
    """Fitted on the distinct vectors of ``vectors`` (x)."""
    spark = vectors.sparkSession
    distinct = stored(vectors.select("x").distinct(), "whitening-fit")
    try:
        counted = added(distinct, dimensions, lambda x: np.append(x.sum(0), len(x)))
        fit = Fit(int(counted[-1]), counted[:-1], np.zeros(0), np.zeros((0, dimensions)), 0.0)
        if fit.n < 2:
            return fit
        centred = fit.centred
        covariance = added(distinct, dimensions, lambda x: centred(x).T @ centred(x)) / fit.n
        covariance = (covariance + covariance.T) / 2
        fit.trace = float(np.trace(covariance))
        fit.values, fit.components = leading_pairs(spark, covariance, leading)
        if len(fit.values):
            whitened = fit.whitened
            around = added(distinct, dimensions, lambda x: whitened(x).T @ whitened(x)) / fit.n
            fit.identity_error = float(np.abs(around - np.eye(len(fit.values))).max())
        return fit
    finally:
        discard(distinct)


def whiten(embeddings: DataFrame, leading: int = LEADING) -> DataFrame:
    """One row (vec_id, component, n, deviation, whitened, explained, identity_error) for each usable row of
    ``embeddings`` (vec_id, embedding) and component."""
    vectors = whole_vectors(embeddings)
    dimensions = usual_length(vectors)
    vectors = vectors.filter(F.size("x") == dimensions)
    fit = fit_whitening(vectors, dimensions, leading)
    known = embeddings.sparkSession.sparkContext.broadcast(fit)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = known.value
        k = len(own.values)
        for batch in batches:
            for start in range(0, batch.num_rows if k else 0, 4096):
                part = batch.slice(start, 4096)
                x = _rows_of(part, dimensions)
                rows = len(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(pa.array(np.repeat(np.arange(rows), k))),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                     pa.array(np.full(rows * k, own.n)),
                     pa.array(own.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                     pa.array(own.whitened(x).ravel()),
                     pa.array(np.tile(own.values / own.trace, rows)),
                     pa.array(np.full(rows * k, own.identity_error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    id_type = vectors.schema["vec_id"].dataType.simpleString()
    return map_rows(vectors, project, f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double")
