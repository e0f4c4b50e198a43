"""Clustering k-sweeps scored by silhouette (k-means and Gaussian mixtures).

All k of a sweep are fitted together: each round is one scan of the rows, in
which tasks fold their rows into partial sums for every centre (k-means) or
component (mixtures) of every k that still moves, and one small shuffle adds
them.  A round's state is the centres of all k, its result ``sum(ks)`` rows of
sums, whatever the number of rows; scans don't grow with the number of k.

* k-means starts from a pool of candidates drawn over all rows in proportion to
  their squared distance from those drawn before (a few scans), weighted by the
  rows nearest to each; every k picks its first centres from that pool.
* Mixtures start from the k-means clusters (their shares, means and
  covariances); a round is one expectation step, whose sums are what the
  maximisation needs.
* All test rows are placed and scored in two scans for all k.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.schemas import SENSOR_GYRO
from ..sources.scores import write_scores

# --- fixed values: seed, cluster counts and stopping rules of the workload ---
SEED = 12321
K_RANGE = tuple(range(2, 12))
KMEANS_ROUNDS, KMEANS_MOVED = 20, 1e-4
MIXTURE_ROUNDS, MIXTURE_GAINED = 100, 0.01
# --- end fixed values ---
DRAWS = 3

SWEEP_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("k", T.IntegerType()),
    T.StructField("silhouette", T.DoubleType()), T.StructField("n_rows", T.LongType()),
    T.StructField("n_misplaced", T.LongType()), T.StructField("fit", T.DoubleType()), T.StructField("fit_of_one", T.DoubleType()),
])

Sums = dict[int, np.ndarray]


def vectors(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The columns as one array ``x`` of doubles; rows with a missing or non-finite one can't be placed and go."""
    x = df.select(F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))
    return x.filter(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))


def summed(rows: DataFrame, fold: Callable[[np.ndarray], Sums]) -> Sums:
    """One scan: the sums over all rows of ``fold(matrix of rows)``, arrays by key."""

    def partial(batches):
        total: Sums = {}
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                for key, values in fold(x).items():
                    total[key] = total[key] + values if key in total else values
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(list(total), [len(v) for v in total.values()]), pa.int32()),
                 pa.array(np.concatenate([np.arange(len(v)) for v in total.values()]), pa.int32()),
                 pa.array(np.concatenate(list(total.values())).astype(np.float64))], names=["key", "place", "value"])

    cells = (rows.mapInArrow(partial, "key int, place int, value double")
             .groupBy("key", "place").agg(F.sum("value").alias("value")).collect())
    sizes = {}
    for r in cells:
        sizes[r["key"]] = max(sizes.get(r["key"], 0), r["place"] + 1)
    out = {key: np.zeros(n) for key, n in sizes.items()}
    for r in cells:
        out[r["key"]][r["place"]] = r["value"]
    return out


def _nearest(x, centres):
    """Place of the nearest of ``centres`` and the squared distance to it, row by row."""
    apart = np.stack([((x - c) ** 2).sum(1) for c in centres], 1)
    at = apart.argmin(1)
    return at, apart[np.arange(len(x)), at]


# ------------------------------------------------------------------ k-means


def _candidates(rows: DataFrame, mean: np.ndarray, most: int) -> np.ndarray:
    """Distinct rows, about ``most`` of each draw, likelier the farther they lie from those drawn before."""
    pool = mean[None]
    nearest = _nearest
    for draw in range(DRAWS):
        own = pool
        cost = summed(rows, lambda x, own=own: {0: np.array([nearest(x, own)[1].sum()])}).get(0, np.zeros(1))[0]
        if cost <= 0:
            break

        def far(batches, own=own, cost=cost):
            for batch in batches:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                if len(x):
                    luck = (batch.column(1).to_numpy() % (1 << 53)) / (1 << 53)
                    yield batch.filter(pa.array(luck * cost < most * nearest(x, own)[1]))

        # equal rows have one luck: they are drawn together and count once
        drawn = rows.withColumn("luck", F.xxhash64(F.lit(SEED + draw), "x")).mapInArrow(far, "x array<double>, luck long").select("x").distinct().collect()
        if drawn:
            pool = np.concatenate([pool, np.array(sorted(tuple(r["x"]) for r in drawn))])
    return pool


def _first_centres(pool: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """``k`` rows of the pool: each the best of some drawn in proportion to weight and squared distance."""
    random = np.random.default_rng(SEED + k)
    chosen = pool[[int(random.choice(len(pool), p=weights / weights.sum()))]]
    while len(chosen) < k:
        left = weights * _nearest(pool, chosen)[1]
        if left.sum() <= 0:  # fewer distinct rows than centres
            return np.concatenate([chosen, np.repeat(chosen[:1], k - len(chosen), 0)])
        tries = random.choice(len(pool), 8, p=left / left.sum())
        costs = [(weights * _nearest(pool, np.concatenate([chosen, pool[[t]]]))[1]).sum() for t in tries]
        chosen = np.concatenate([chosen, pool[[tries[int(np.argmin(costs))]]]])
    return chosen


def kmeans_all(rows: DataFrame, ks: tuple[int, ...] = K_RANGE) -> tuple[dict[int, np.ndarray], dict[int, float]]:
    """Centres of each k, and its mean squared distance of a row from its centre (of 1: from the mean)."""
    nearest = _nearest
    totals = summed(rows, lambda x: {0: np.concatenate([[len(x)], x.sum(0)])})
    if not totals:
        return {}, {}
    n, mean = totals[0][0], totals[0][1:] / totals[0][0]
    pool = _candidates(rows, mean, 2 * max(ks))

    def sums(active):
        def fold(x):
            out = {}
            for k, centres in active.items():
                at, apart = nearest(x, centres)
                own = at[:, None] == np.arange(len(centres))
                out[k] = np.concatenate([own.sum(0), (own.T.astype(float) @ x).ravel(), [apart.sum()]])
            return out

        return summed(rows, fold)

    start = sums({0: pool, 1: mean[None]})
    centres = {k: _first_centres(pool, start[0][:len(pool)], k) for k in ks}
    cost = {1: start[1][-1] / n}
    moving = set(ks)
    for _ in range(KMEANS_ROUNDS):
        if not moving:
            break
        for k, s in sums({k: centres[k] for k in sorted(moving)}).items():
            counts, means = s[:k], s[k:-1].reshape(k, -1)
            new = np.where(counts[:, None] > 0, means / np.maximum(counts, 1)[:, None], centres[k])
            if np.sqrt(((new - centres[k]) ** 2).sum(1)).max() <= KMEANS_MOVED:
                moving.discard(k)
            centres[k] = new
    for k, s in sums(centres).items():
        cost[k] = s[-1] / n
    return centres, cost


# ----------------------------------------------------------------- mixtures


def _log_densities(x, shares, means, covariances):
    """log(share * density) of each row in each component."""
    out = []
    for share, mean, covariance in zip(shares, means, covariances, strict=True):
        root = np.linalg.cholesky(covariance)
        z = np.linalg.solve(root, (x - mean).T)
        out.append(np.log(max(share, 1e-300)) - 0.5 * ((z * z).sum(0) + len(mean) * np.log(2 * np.pi)) - np.log(np.diag(root)).sum())
    return np.stack(out, 1)


def _weighted_sums(x, weights):
    """Of each component: weight, weighted sum, weighted products."""
    return np.concatenate([weights.sum(0), (weights.T @ x).ravel(), np.einsum("nk,ni,nj->kij", weights, x, x).ravel()])


def mixture_all(rows: DataFrame, ks: tuple[int, ...] = K_RANGE) -> tuple[dict[int, tuple], dict[int, float]]:
    """(shares, means, covariances) of each k, and its mean log-likelihood of a row (of 1: of one Gaussian)."""
    centres, _ = kmeans_all(rows, ks)
    if not centres:
        return {}, {}
    nearest, densities, products = _nearest, _log_densities, _weighted_sums
    middle = next(iter(centres.values())).mean(0)  # taken off before multiplying, so that little is lost
    first = summed(rows, lambda x: {1: products(x - middle, np.ones((len(x), 1)))} | {
        k: products(x - middle, (nearest(x, c)[0][:, None] == np.arange(len(c))).astype(float)) for k, c in centres.items()})
    d = len(middle)

    def model(k, s, least):
        weight, sums, squares = s[:k], s[k:k + k * d].reshape(k, d), s[k + k * d:k + k * d + k * d * d].reshape(k, d, d)
        safe = np.maximum(weight, 1e-300)
        means = sums / safe[:, None]
        spread = squares / safe[:, None, None] - means[:, :, None] * means[:, None, :]
        empty = weight < 1e-9
        spread[empty] = whole
        return weight / weight.sum(), means + middle, spread + least * np.eye(d)

    whole = np.eye(d)
    whole = model(1, first[1], 0.0)[2][0]
    least = 1e-9 * max(float(np.trace(whole)), 1e-12)
    n = first[1][0]
    models = {k: model(k, s, least) for k, s in first.items()}
    likelihood = dict.fromkeys(models, -np.inf)
    moving = set(models)
    for _ in range(MIXTURE_ROUNDS):
        if not moving:
            break
        active = {k: models[k] for k in sorted(moving)}

        def fold(x, active=active):
            out = {}
            for k, own in active.items():
                logs = densities(x, *own)
                top = logs.max(1, keepdims=True)
                parts = np.exp(logs - top)
                whole_row = parts.sum(1, keepdims=True)
                out[k] = np.append(products(x - middle, parts / whole_row), (np.log(whole_row) + top).sum())
            return out

        for k, s in summed(rows, fold).items():
            if s[-1] - likelihood[k] <= MIXTURE_GAINED:
                moving.discard(k)  # the model that this likelihood is of stays
            else:
                models[k] = model(k, s[:-1], least)
            likelihood[k] = s[-1]
    models.pop(1)
    return models, {k: v / n for k, v in likelihood.items()}


# -------------------------------------------------------------------- sweeps


def _placers(model: str, fitted: dict) -> dict[int, Callable]:
    """Of each k: rows → (their cluster, whether another one is nearer or likelier beyond rounding)."""
    nearest, densities = _nearest, _log_densities

    def kmeans(centres):
        norms = (centres ** 2).sum(1)

        def place(x):
            at = (norms - 2 * x @ centres.T).argmin(1)
            return at, ((x - centres[at]) ** 2).sum(1) > nearest(x, centres)[1] + 1e-9

        return place

    def mixture(own):
        inverse = np.linalg.inv(own[2])
        scale = np.log(np.maximum(own[0], 1e-300)) - 0.5 * np.linalg.slogdet(own[2])[1]

        def place(x):
            away = x[:, None] - own[1]
            at = (scale - 0.5 * np.einsum("nki,kij,nkj->nk", away, inverse, away)).argmax(1)
            logs = densities(x, *own)
            return at, logs[np.arange(len(x)), at] < logs.max(1) - 1e-6

        return place

    return {k: (kmeans if model == "kmeans" else mixture)(v) for k, v in fitted.items()}


def silhouettes(rows: DataFrame, placers: dict[int, Callable], sizes: dict[int, int]) -> dict[int, tuple[float | None, int, int]]:
    """(mean silhouette, rows, misplaced rows) of each k, in two scans for all of them.

    As ``metrics.silhouette``: squared distances through each cluster's count,
    sum and sum of squares; null if all rows lie in one cluster.
    """

    def gather(x):
        out = {}
        for k, place in placers.items():
            at, off = place(x)
            own = (at[:, None] == np.arange(sizes[k])).astype(float)
            out[k] = np.concatenate([own.sum(0), own.T @ (x * x).sum(1), (own.T @ x).ravel(), [off.sum()]])
        return out

    stats = summed(rows, gather)

    def score(x):
        out, square = {}, (x * x).sum(1)
        for k, place in placers.items():
            n, squares, sums = stats[k][:sizes[k]], stats[k][sizes[k]:2 * sizes[k]], stats[k][2 * sizes[k]:-1].reshape(sizes[k], -1)
            held = n > 0
            at, rows_ = place(x)[0], np.arange(len(x))
            mean = square[:, None] + squares / np.maximum(n, 1) - 2 * x @ sums.T / np.maximum(n, 1)
            a = mean[rows_, at] * n[at] / np.maximum(n[at] - 1, 1)
            mean[:, ~held] = np.inf
            mean[rows_, at] = np.inf
            b = mean.min(1)
            larger = np.maximum(a, b)
            s = np.where((n[at] == 1) | (larger <= 0), 0.0, (b - a) / np.where(larger > 0, larger, 1.0))
            out[k] = np.array([s.sum() if held.sum() > 1 else 0.0])
        return out

    scored = summed(rows, score)
    out = {}
    for k, own in stats.items():
        n = int(own[:sizes[k]].sum())
        out[k] = (float(scored[k][0] / n) if (own[:sizes[k]] > 0).sum() > 1 else None, n, int(own[-1]))
    return out


def sweep(model: str, train: DataFrame, test: DataFrame, columns: tuple[str, ...] = SENSOR_GYRO,
          ks: tuple[int, ...] = K_RANGE, path: str | None = None) -> DataFrame:
    """``model, k, silhouette, n_rows, n_misplaced, fit, fit_of_one``: fit on train, place and score the test rows.

    ``n_misplaced`` counts test rows that are not with their nearest centre
    (k-means) or likeliest component (mixture); it is 0.  ``fit`` is the train
    rows' mean squared distance (k-means, falling) or log-likelihood (mixture,
    rising), ``fit_of_one`` that of a single cluster.
    Silhouette is null when every test row falls into one cluster (undefined).
    A table without train rows gives no row.  With ``path``, the board is also
    appended to the score table there as one run.
    """
    # kept for all scans of the sweep; what a lost executor held is read again
    tr, te = vectors(train, columns).persist(), vectors(test, columns).persist()
    try:
        fitted, fit = (kmeans_all if model == "kmeans" else mixture_all)(tr, ks)
        placed = silhouettes(te, _placers(model, fitted), {k: k for k in fitted}) if fitted else {}
        rows = [(model, k, *placed.get(k, (None, 0, 0)), float(fit[k]), float(fit[1])) for k in fitted]
    finally:
        tr.unpersist()
        te.unpersist()
    board = train.sparkSession.createDataFrame(rows, SWEEP_SCHEMA)
    if path:
        write_scores(board, path)
    return board
