"""Fitting and applying the three clustering algorithms.

A fitted model is a handful of numbers. Assignment is a column expression; a fit
reads the prepared matrix once per iteration and returns only sums to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buyerlens.functions.scalars import hash_position
from buyerlens.operators.cluster_metrics import squared_distance
from buyerlens.operators.ranking import first_by_hash

# mini-batch fits: batches that a group of rows takes in one pass, and when a centre is starved
GROUP_BATCHES = 64
STARVED = 0.01
STARVED_EPOCHS = 3


def first_smallest(scores: list[Column]) -> Column:
    """Index of the smallest of the given columns; the first one on ties. Null where one is null or NaN."""
    unknown = reduce(lambda a, b: a | b, [s.isNull() | F.isnan(s) for s in scores])
    smallest = F.least(*scores) if len(scores) > 1 else scores[0]
    index = F.lit(len(scores) - 1)
    for k in range(len(scores) - 2, -1, -1):
        index = F.when(scores[k] <= smallest, k).otherwise(index)
    return F.when(~unknown, index).cast("int")


def _by_score(df: DataFrame, scores: list[Column], out: str) -> DataFrame:
    # named score columns keep each distance from being written out twice
    names = [f"_score{k}" for k in range(len(scores))]
    scored = df.select("*", *[s.alias(n) for s, n in zip(scores, names)])
    return scored.withColumn(out, first_smallest([F.col(n) for n in names])).drop(*names)


@dataclass(frozen=True)
class CentroidModel:
    """K centroids over the prepared columns."""

    columns: list[str]
    centres: list[list[float]]
    cost: float | None = None

    @property
    def k(self) -> int:
        return len(self.centres)

    def assign(self, df: DataFrame, out: str = "segment_id") -> DataFrame:
        return _by_score(df, [squared_distance(self.columns, c) for c in self.centres], out)

    def with_distance(self, df: DataFrame, out: str = "d2") -> DataFrame:
        distances = [squared_distance(self.columns, c) for c in self.centres]
        return df.withColumn(out, F.least(*distances) if len(distances) > 1 else distances[0])


@dataclass(frozen=True)
class MixtureModel:
    """Gaussian mixture with diagonal covariances."""

    columns: list[str]
    weights: list[float]
    means: list[list[float]]
    variances: list[list[float]]
    log_likelihood: float | None = None

    @property
    def k(self) -> int:
        return len(self.weights)

    def _log_density(self, k: int) -> Column:
        constant = math.log(self.weights[k]) - 0.5 * sum(
            math.log(2 * math.pi * v) for v in self.variances[k]
        )
        exponent = F.lit(0.0)
        for c, m, v in zip(self.columns, self.means[k], self.variances[k]):
            gap = F.col(c) - F.lit(m)
            exponent = exponent + gap * gap / F.lit(v)
        return F.lit(constant) - exponent * 0.5

    def assign(self, df: DataFrame, out: str = "segment_id") -> DataFrame:
        """Component with the largest responsibility."""
        return _by_score(df, [-self._log_density(k) for k in range(self.k)], out)

    def information_criteria(self, n: int, log_likelihood: float | None = None) -> tuple[float, float]:
        """(BIC, AIC) for ``n`` rows of this likelihood, that of the training rows when none is given."""
        level = self.log_likelihood if log_likelihood is None else log_likelihood
        d = len(self.columns)
        parameters = 2 * self.k * d + self.k - 1
        return (parameters * math.log(n) - 2 * level, 2 * parameters - 2 * level)

    def likelihood_of(self, df: DataFrame) -> tuple[int, float]:
        """Rows of ``df`` and their log-likelihood, in one aggregate."""
        names = [f"_log{k}" for k in range(self.k)]
        logs = df.select(*[self._log_density(k).alias(n) for k, n in enumerate(names)])
        top = F.greatest(*names) if self.k > 1 else F.col(names[0])
        share = reduce(lambda a, b: a + b, [F.exp(F.col(n) - F.col("_top")) for n in names])
        found = logs.withColumn("_top", top).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("_top") + F.log(share)).alias("level")).first()
        return found["n"], found["level"]


def _summed(df: DataFrame, columns: list[str], partial: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of ``partial(block)`` over all blocks of rows, with block a rows x columns matrix.

    Each task returns one vector. The vectors are added by position in a shuffle,
    so that the driver receives one vector however many tasks there are."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                vector = partial(batch.to_numpy("float64"))
                total = vector if total is None else total + vector
        if total is not None:
            yield pd.DataFrame({"v": [total]})

    vectors = df.select(*columns).mapInPandas(run, "v array<double>")
    return _added(vectors)


def _added(vectors: DataFrame) -> np.ndarray:
    """Sum of the vectors ``v`` by position."""
    rows = (
        vectors.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    )
    result = np.zeros(len(rows))
    for row in rows:
        result[row["i"]] = row["x"]
    return result


def seeded_rows(df: DataFrame, columns: list[str], id_column: str, rows: int, seed: int) -> np.ndarray:
    """A bounded reproducible sample of the matrix, in hash order."""
    return first_by_hash(df, id_column, rows, seed).select(*columns).toPandas().to_numpy("float64")


def spread_centres(points: np.ndarray, k: int, rng: np.random.RandomState) -> np.ndarray:
    """k-means++ seeding on a bounded sample (Arthur and Vassilvitskii 2007)."""
    centres = [points[rng.randint(len(points))]]
    d2 = ((points - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k:
        total = d2.sum()
        pick = rng.choice(len(points), p=d2 / total) if total > 0 else rng.randint(len(points))
        centres.append(points[pick])
        d2 = np.minimum(d2, ((points - points[pick]) ** 2).sum(axis=1))
    return np.array(centres)


def fit_kmeans(df: DataFrame, columns: list[str], k: int, n_init: int = 10, seed: int = 42,
               max_iter: int = 300, tol: float = 1e-4, parallelism: int = 8) -> CentroidModel:
    """Best of ``n_init`` seeded fits of the built-in k-means by training cost.

    The fits share one cached matrix and run side by side."""
    matrix = VectorAssembler(inputCols=columns, outputCol="features").transform(
        df.select(*columns)
    ).select("features").persist()
    try:
        @inheritable_thread_target(df.sparkSession)
        def fit(i: int):
            estimator = KMeans(k=k, seed=seed + i, maxIter=max_iter, tol=tol, initMode="k-means||")
            return estimator.fit(matrix)

        matrix.count()
        with ThreadPool(min(parallelism, n_init)) as pool:
            fitted = pool.map(fit, range(n_init))
        best = min(fitted, key=lambda m: m.summary.trainingCost)
        return CentroidModel(
            list(columns), [[float(x) for x in c] for c in best.clusterCenters()],
            float(best.summary.trainingCost),
        )
    finally:
        matrix.unpersist()


def fit_minibatch_kmeans(df: DataFrame, columns: list[str], k: int, id_column: str,
                         batch_size: int = 1024, n_init: int = 10, seed: int = 42,
                         max_epochs: int = 20, patience: int = 2, tol: float = 1e-4) -> CentroidModel:
    """Mini-batch k-means with per-centre learning rates (Sculley 2010) over all rows.

    Rows are dealt by hash into groups of about ``GROUP_BATCHES`` batches. In an epoch, one pass, each
    group takes its batches one after the other from the epoch's centres, and the groups' centres are
    averaged by the rows that they saw. Starting centres are the best of ``n_init`` seedings on a
    sample of three batches. In the first epochs a centre with less than ``STARVED`` of the largest one's
    rows moves to a row far from all centres. It ends when the mean cost has not improved by the share
    ``tol`` for ``patience`` epochs."""
    total = df.count()
    groups = max(1, math.ceil(total / (batch_size * GROUP_BATCHES)))
    position = hash_position(F.col(id_column), seed)
    dealt = df.select(
        *[F.col(c).cast("double").alias(c) for c in columns], position.alias("_position"),
    ).withColumn("_group", F.pmod("_position", F.lit(groups)))
    dealt = dealt.repartition("_group").persist()
    try:
        first = seeded_rows(df, columns, id_column, 3 * batch_size, seed)
        rng = np.random.RandomState(seed)
        starts = [spread_centres(first, k, rng) for _ in range(n_init)]
        costs = [_nearest(first, c)[1].sum() for c in starts]
        centres, counts = starts[int(np.argmin(costs))].copy(), np.zeros(k)
        best, waited = math.inf, 0
        for epoch in range(max_epochs):
            run = _epoch(columns, centres, counts / groups, batch_size)
            passed = dealt.groupBy("_group").applyInPandas(run, "v array<double>, far double, row array<double>")
            passed = passed.persist()
            try:
                sums = _added(passed)
                seen, moved, cost = sums[:k], sums[k:-1].reshape(k, -1), sums[-1]
                hit = seen > 0
                centres = centres.copy()
                centres[hit] = moved[hit] / seen[hit, None]
                counts = counts + seen
                starved = np.flatnonzero(seen < STARVED * seen.max())
                if len(starved) and epoch < STARVED_EPOCHS:
                    far = passed.orderBy(F.desc("far"), "row").limit(len(starved)).collect()
                    for c, row in zip(starved, far):
                        centres[c], counts[c] = row["row"], 0
                    continue
            finally:
                passed.unpersist()
            waited = 0 if cost < best * (1 - tol) else waited + 1
            best = min(best, cost)
            if waited >= patience:
                break
        model = CentroidModel(list(columns), centres.tolist())
        cost = model.with_distance(df).agg(F.sum("d2")).first()[0]
        return CentroidModel(list(columns), centres.tolist(), cost)
    finally:
        dealt.unpersist()


def _epoch(columns: list[str], start: np.ndarray, before: np.ndarray, batch_size: int):
    """One group's pass: rows seen per centre, its centres times these, the cost; and its farthest row."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        rows = group.sort_values(["_position", *columns])[columns].to_numpy("float64")
        centres, counts, seen, cost, far, farthest = start.copy(), before.copy(), np.zeros(len(start)), 0.0, -1.0, rows[0]
        for low in range(0, len(rows), batch_size):
            block = rows[low : low + batch_size]
            own, d2 = _nearest(block, centres)
            if d2.max() > far:
                far, farthest = float(d2.max()), block[d2.argmax()]
            sums = _assignment_sums(block, centres)
            sums, cost = sums[:-1].reshape(len(centres), -1), cost + sums[-1]
            here = sums[:, 0]
            counts += here
            seen += here
            hit = here > 0
            rate = (here[hit] / counts[hit])[:, None]
            centres[hit] = (1 - rate) * centres[hit] + rate * (sums[hit, 1:] / here[hit, None])
        vector = np.concatenate([seen, (centres * seen[:, None]).ravel(), [cost]])
        return pd.DataFrame({"v": [vector], "far": [far], "row": [farthest]})
    return run


def _nearest(block: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d2 = ((block[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
    own = d2.argmin(axis=1)
    return own, d2[np.arange(len(block)), own]


def _assignment_sums(block: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Per centre the count and column sums of its rows, then the total cost."""
    own, d2 = _nearest(block, centres)
    k = len(centres)
    counts = np.bincount(own, minlength=k)
    sums = np.stack([np.bincount(own, weights=block[:, j], minlength=k) for j in range(block.shape[1])], axis=1)
    return np.append(np.column_stack([counts, sums]).ravel(), d2.sum())


def _log_densities(block, weights, means, variances) -> np.ndarray:
    gaps = ((block[:, None, :] - means[None]) ** 2 / variances[None]).sum(axis=2)
    return np.log(weights) - 0.5 * (gaps + np.log(2 * np.pi * variances).sum(axis=1))


def _responsibility_sums(block: np.ndarray, starts: list[tuple]) -> np.ndarray:
    """For every set of parameters: per component weight, sums and square sums; then the log-likelihood."""
    out = []
    for weights, means, variances in starts:
        logs = _log_densities(block, weights, means, variances)
        top = logs.max(axis=1, keepdims=True)
        norm = top[:, 0] + np.log(np.exp(logs - top).sum(axis=1))
        share = np.exp(logs - norm[:, None])
        out += [share.sum(axis=0), (share.T @ block).ravel(), (share.T @ block**2).ravel(), [norm.sum()]]
    return np.concatenate(out)


def fit_gaussian_mixture(df: DataFrame, columns: list[str], k: int, id_column: str, n_init: int = 2,
                         seed: int = 42, max_iter: int = 100, tol: float = 1e-3,
                         floor: float = 1e-6) -> MixtureModel:
    """Diagonal Gaussian mixture by EM, all restarts in the same passes.

    Each restart begins at the k-means partition of its own seed. A pass returns
    K * (2d + 1) + 1 sums per restart. ``floor`` is added to every variance."""
    d = len(columns)
    n = df.count()
    matrix = df.select(*columns).persist()
    try:
        starts = []
        for i in range(n_init):
            model = fit_kmeans(matrix, columns, k, n_init=1, seed=seed + i)
            centres = np.array(model.centres)
            sums = _summed(matrix, columns, lambda block, c=centres: _hard_sums(block, c))
            starts.append(_maximise(sums, n, len(centres), d, floor))
        best, last = [None] * n_init, [-math.inf] * n_init
        active = list(range(n_init))
        for _ in range(max_iter):
            current = [starts[i] for i in active]
            sums = _summed(matrix, columns, lambda block, p=current: _responsibility_sums(block, p))
            offset, still = 0, []
            for i in active:
                width = len(starts[i][0]) * (2 * d + 1) + 1
                part = sums[offset:offset + width]
                offset += width
                level = part[-1] / n
                best[i] = (part[-1], starts[i])
                if abs(level - last[i]) >= tol:
                    still.append(i)
                    starts[i] = _maximise(part[:-1], n, len(starts[i][0]), d, floor)
                last[i] = level
            active = still
            if not active:
                break
        likelihood, (weights, means, variances) = max(best, key=lambda b: b[0])
        return MixtureModel(list(columns), weights.tolist(), means.tolist(), variances.tolist(), float(likelihood))
    finally:
        matrix.unpersist()


def _hard_sums(block: np.ndarray, centres: np.ndarray) -> np.ndarray:
    own, _ = _nearest(block, centres)
    share = np.eye(len(centres))[own]
    return np.concatenate([share.sum(axis=0), (share.T @ block).ravel(), (share.T @ block**2).ravel()])


def _maximise(sums: np.ndarray, n: int, k: int, d: int, floor: float):
    mass = sums[:k] + 10 * np.finfo(float).eps
    means = sums[k:k + k * d].reshape(k, d) / mass[:, None]
    variances = sums[k + k * d:].reshape(k, d) / mass[:, None] - means**2
    return mass / mass.sum(), means, np.maximum(variances, 0) + floor


# by name: the fit, whether it takes the id column, and the parameters a trial may set
_FITS = {
    "kmeans": (fit_kmeans, False, {"n_init"}),
    "minibatch_kmeans": (fit_minibatch_kmeans, True, {"n_init", "batch_size"}),
    "gaussian_mixture": (fit_gaussian_mixture, True, {"n_init"}),
}


def known_algorithm(name: str) -> str:
    """The algorithm's own name; ``gmm`` is short for the mixture."""
    own = {"gmm": "gaussian_mixture"}.get(name.lower(), name.lower())
    if own not in _FITS:
        raise ValueError(f"unknown clustering {name!r}; there are {', '.join(_FITS)}")
    return own


def checked_params(algorithm: str, params: dict) -> tuple[str, dict[str, int]]:
    """The algorithm's own name and its parameters as numbers; unknown ones are errors."""
    name, params = known_algorithm(algorithm), dict(params)
    if name == "gaussian_mixture" and params.pop("covariance_type", "diag") != "diag":
        raise ValueError("only diagonal covariances are supported")
    if unknown := set(params) - _FITS[name][2]:
        raise ValueError(f"{name} takes no {', '.join(sorted(unknown))}")
    return name, {key: int(value) for key, value in params.items()}


def fit_clusterer(algorithm: str, df: DataFrame, columns: list[str], id_column: str, k: int,
                  seed: int = 42, **params):
    """Fit the named algorithm; names and parameters that it does not know are errors."""
    name, given = checked_params(algorithm, params)
    fit, by_id, _ = _FITS[name]
    return fit(df, columns, k, *([id_column] if by_id else []), seed=seed, **given)
