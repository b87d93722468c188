"""Fitting and measuring many clusterings in shared passes over one matrix.

A search has grid points, each is fitted on all rows and on subsamples, most from several starts. All of
them read the same rows, so a pass carries the sums of every model that is still moving and the driver
updates them all: the number of jobs is that of the slowest model, not of all models together. A *view* is
a set of rows with its own preparation: view 0 has all rows, the others are subsamples.

Rows are dealt once by hash into groups of bounded size, each sorted by its hash. A task takes its groups
one after the other; the sums do not depend on how groups are spread over tasks. What reaches the driver
is one vector per pass, of some numbers per model and cluster."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buyerlens.functions.scalars import hash_position
from buyerlens.operators import clustering as C
from buyerlens.operators.preprocess import FEATURE_COLUMNS, Preprocessor, fit_preprocessor
from buyerlens.operators.profiles import RFM
from buyerlens.operators.ranking import first_by_hash, in_samples
from buyerlens.session import checkpointed

GROUP_ROWS = 1 << 16
SAMPLE_ROWS = 3 * 1024
LLOYD_ROUNDS, EPOCHS, EM_ROUNDS = 300, 20, 100
LLOYD_TOL, EPOCH_TOL, EM_TOL = 1e-4, 1e-4, 1e-3
PATIENCE = 2
RESTARTS = {"kmeans": 10, "minibatch_kmeans": 10, "gaussian_mixture": 2}
FLOOR = 1e-6
# columns summed for profiles
PROFILED = (*RFM, "avg_ticket")


@dataclass(frozen=True)
class Matrix:
    """Prepared rows in groups: per view its ``z`` columns and, beyond the first, who belongs to it."""

    rows: DataFrame
    views: list[Preprocessor]
    sizes: list[int]
    samples: list[np.ndarray]

    @property
    def width(self) -> int:
        return len(self.views[0].outputs)

    def columns(self, view: int) -> list[str]:
        return [f"z{view}_{j}" for j in range(self.width)]


@dataclass
class Member:
    """One model on its way: a grid point on a view from one start."""

    spec: int
    view: int
    method: str
    centres: np.ndarray
    batch_size: int = 1024
    mixture: tuple | None = None
    seen: np.ndarray | None = None
    cost: float = math.inf
    best: float = math.inf
    rounds: int = 0
    waited: int = 0
    done: bool = False
    then_em: bool = field(default=False)

    @property
    def state(self) -> tuple:
        return (self.method, self.view, self.centres, self.mixture, self.seen, self.batch_size, self.then_em)


def prepared(features: DataFrame, id_column: str, n_subsamples: int = 0, fraction: float = 0.8, seed: int = 42,
             columns: list[str] | None = None) -> Matrix:
    """Materialise the matrix of all views; each view's preparation is fitted once, on its own rows."""
    wanted = columns or FEATURE_COLUMNS
    base = checkpointed(features.select(id_column, *[
        F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in dict.fromkeys([*wanted, *PROFILED])]))
    total = base.count()
    inside = in_samples(base, id_column, fraction, [seed + i for i in range(n_subsamples)]) if n_subsamples else []
    masks: list[Column | None] = [None, *inside]
    views = [fit_preprocessor(base if m is None else base.where(m), wanted) for m in masks]
    groups = max(1, -(-total // GROUP_ROWS))
    position = hash_position(F.col(id_column), seed)
    dealt = base.select(
        F.pmod(position, F.lit(groups)).cast("int").alias("_group"), position.alias("_position"), F.col(id_column).alias("_id"),
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(f"raw_{c}") for c in PROFILED],
        *[F.col(c).isNotNull().cast("double").alias(f"has_{c}") for c in PROFILED],
        *[e.alias(f"z{v}_{j}") for v, view in enumerate(views) for j, e in enumerate(view.expressions())],
        *[m.alias(f"in{v}") for v, m in enumerate(masks) if m is not None])
    rows = checkpointed(dealt.repartition("_group").sortWithinPartitions("_group", "_position", F.col("_id").cast("string")))
    sizes = rows.agg(F.count(F.lit(1)), *[F.count_if(f"in{v}") for v in range(1, len(views))]).first()
    matrix = Matrix(rows, views, list(sizes), [])
    for v in range(len(views)):
        own = rows if v == 0 else rows.where(f"in{v}")
        matrix.samples.append(first_by_hash(own, "_id", SAMPLE_ROWS, seed).select(*matrix.columns(v)).toPandas().to_numpy("float64"))
    return matrix


def starts(matrix: Matrix, specs: list[dict], seed: int = 42) -> list[Member]:
    """Members of all grid points on all views from seeded starts, by k-means++ on a view's bounded sample."""
    members = []
    for s, spec in enumerate(specs):
        name, params = C.checked_params(spec["algorithm"], spec["params"])
        n_init = params.get("n_init", RESTARTS[name])
        for view, sample in enumerate(matrix.samples):
            seeds = [C.spread_centres(sample, spec["n_clusters"], np.random.RandomState(seed + i)) for i in range(n_init)]
            if name == "minibatch_kmeans":
                costs = [C._nearest(sample, c)[1].sum() for c in seeds]
                seeds = [seeds[int(np.argmin(costs))]]
            members += [_member(s, view, name, c, spec) for c in seeds]
    return members


def given_starts(matrix: Matrix, specs: list[dict], centres: list[list[float]]) -> list[Member]:
    """Members that begin at the first rows of ``centres``, on every view."""
    return [
        _member(s, view, C.checked_params(spec["algorithm"], spec["params"])[0], np.array(centres[: spec["n_clusters"]], dtype=float), spec)
        for s, spec in enumerate(specs) for view in range(len(matrix.views))]


def _member(spec: int, view: int, name: str, centres: np.ndarray, point: dict) -> Member:
    if name == "minibatch_kmeans":
        return Member(spec, view, "batches", centres, int(point["params"].get("batch_size", 1024)), seen=np.zeros(len(centres)))
    return Member(spec, view, "lloyd", centres, then_em=name == "gaussian_mixture")


# --- passes ---------------------------------------------------------------------------------

def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The groups of a task, each whole; they lie one after the other."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        number = batch["_group"].to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(number)) + 1), len(number)]
        for low, high in zip(cuts, cuts[1:]):
            part = batch.iloc[low:high]
            if held and len(part) and held[0]["_group"].iloc[0] != part["_group"].iloc[0]:
                yield pd.concat(held)
                held = []
            if len(part):
                held.append(part)
    if held:
        yield pd.concat(held)


def _pass(matrix: Matrix, partial: Callable[[list[np.ndarray], pd.DataFrame], np.ndarray]) -> np.ndarray:
    """Sum of ``partial(blocks of all views, group)`` over all groups, in one job."""
    names, views = [matrix.columns(v) for v in range(len(matrix.views))], len(matrix.views)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for group in _groups(batches):
            blocks = [group[names[v]].to_numpy("float64") for v in range(views)]
            vector = partial(blocks, group)
            total = vector if total is None else total + vector
        if total is not None:
            yield pd.DataFrame({"v": [total]})

    return C._added(matrix.rows.mapInPandas(run, "v array<double>"))


def _sums(state: tuple, rows: np.ndarray) -> np.ndarray:
    method, _, centres, mixture, seen, batch_size, squares = state
    if method == "em":
        return C._responsibility_sums(rows, [mixture])
    if method == "batches":
        return _taken_in_batches(rows, centres, seen, batch_size)
    if squares:
        own, d2 = C._nearest(rows, centres)
        return np.append(C._hard_sums(rows, centres), d2.sum())
    return C._assignment_sums(rows, centres)


def _taken_in_batches(rows: np.ndarray, start: np.ndarray, before: np.ndarray, batch_size: int) -> np.ndarray:
    """A group's pass: rows seen per centre, its centres times these, and the cost."""
    centres, counts, seen, cost = start.copy(), before.copy(), np.zeros(len(start)), 0.0
    for low in range(0, len(rows), batch_size):
        sums = C._assignment_sums(rows[low : low + batch_size], centres)
        sums, cost = sums[:-1].reshape(len(centres), -1), cost + sums[-1]
        here = sums[:, 0]
        counts, seen, hit = counts + here, seen + here, here > 0
        rate = (here[hit] / counts[hit])[:, None]
        centres[hit] = (1 - rate) * centres[hit] + rate * (sums[hit, 1:] / here[hit, None])
    return np.concatenate([seen, (centres * seen[:, None]).ravel(), [cost]])


def fit_all(matrix: Matrix, members: list[Member], rounds: int | None = None) -> list[Member]:
    """Move all members until each has settled, or for exactly ``rounds`` rounds of each of its methods."""
    groups = max(1, -(-matrix.sizes[0] // GROUP_ROWS))
    while moving := [m for m in members if not m.done]:
        states = [(*m.state[:4], None if m.seen is None else m.seen / groups, *m.state[5:]) for m in moving]

        def partial(blocks: list[np.ndarray], group: pd.DataFrame) -> np.ndarray:
            masked = [b if v == 0 else b[group[f"in{v}"].to_numpy(bool)] for v, b in enumerate(blocks)]
            return np.concatenate([_sums(s, masked[s[1]]) for s in states])

        vector, at = _pass(matrix, partial), 0
        for member in moving:
            k = len(member.centres)
            width = k * (2 * matrix.width + 1) + 1 if member.method == "em" or member.then_em else k * (matrix.width + 1) + 1
            _update(member, vector[at : at + width], matrix, rounds)
            at += width
    return members


def _update(m: Member, sums: np.ndarray, matrix: Matrix, rounds: int | None) -> None:
    k, d, n = len(m.centres), matrix.width, matrix.sizes[m.view]
    m.rounds += 1
    if m.method == "em":
        level = sums[-1] / n
        m.cost = -float(sums[-1])
        # the likelihood is that of the parameters which it was taken with
        settled = m.rounds > rounds if rounds else abs(level - m.best) < EM_TOL or m.rounds > EM_ROUNDS
        m.best = level
        if settled:
            m.done = True
        else:
            m.mixture = C._maximise(sums[:-1], n, k, d, FLOOR)
        return
    if m.method == "batches":
        seen, moved, m.cost = sums[:k], sums[k:-1].reshape(k, d), float(sums[-1])
        hit = seen > 0
        m.centres = np.where(hit[:, None], moved / np.maximum(seen, 1)[:, None], m.centres)
        m.seen = m.seen + seen
        if rounds:
            m.done = m.rounds >= rounds
            return
        starved = np.flatnonzero(seen < C.STARVED * seen.max())
        if len(starved) and m.rounds <= C.STARVED_EPOCHS:
            # a centre that gets next to nothing moves to a row of the sample far from all others
            for c in starved:
                _, d2 = C._nearest(matrix.samples[m.view], m.centres)
                m.centres[c], m.seen[c] = matrix.samples[m.view][int(d2.argmax())], 0
            return
        m.waited = 0 if m.cost < m.best * (1 - EPOCH_TOL) else m.waited + 1
        m.best = min(m.best, m.cost)
        m.done = m.waited >= PATIENCE or m.rounds >= EPOCHS
        return
    m.cost = float(sums[-1])
    if m.then_em:
        counts, total = sums[:k], sums[k : k + k * d].reshape(k, d)
    else:
        table = sums[:-1].reshape(k, -1)
        counts, total = table[:, 0], table[:, 1:]
    new = np.where(counts[:, None] > 0, total / np.maximum(counts, 1)[:, None], m.centres)
    shift = float(np.sqrt(((new - m.centres) ** 2).sum(axis=1)).max())
    if m.then_em and (rounds or shift <= LLOYD_TOL or m.rounds >= LLOYD_ROUNDS):
        # with given starts, the first partition alone begins the mixture
        m.method, m.mixture, m.rounds, m.best, m.then_em = "em", C._maximise(sums[:-1], n, k, d, FLOOR), 0, -math.inf, False
        return
    m.centres = new
    m.done = m.rounds >= rounds if rounds else shift <= LLOYD_TOL or m.rounds >= LLOYD_ROUNDS


def best_models(matrix: Matrix, members: list[Member]) -> dict[tuple[int, int], C.CentroidModel | C.MixtureModel]:
    """Of each (grid point, view) the start that ended at the least cost or the greatest likelihood."""
    found: dict[tuple[int, int], Member] = {}
    for m in members:
        if (m.spec, m.view) not in found or m.cost < found[m.spec, m.view].cost:
            found[m.spec, m.view] = m

    def model(m: Member):
        columns = matrix.views[m.view].outputs
        if m.mixture is None:
            return C.CentroidModel(columns, m.centres.tolist(), m.cost)
        return C.MixtureModel(columns, *[np.asarray(part).tolist() for part in m.mixture], -m.cost)

    return {key: model(m) for key, m in found.items()}


# --- measures ---------------------------------------------------------------------------------

def _labels(model: C.CentroidModel | C.MixtureModel, rows: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Labels of rows, and their cost or their log-likelihood."""
    if isinstance(model, C.MixtureModel):
        logs = C._log_densities(rows, *[np.array(p) for p in (model.weights, model.means, model.variances)])
        top = logs.max(axis=1)
        return logs.argmax(axis=1), 0.0, float((top + np.log(np.exp(logs - top[:, None]).sum(axis=1))).sum())
    own, d2 = C._nearest(rows, np.array(model.centres))
    return own, float(d2.sum()), 0.0


def measure_all(matrix: Matrix, models: dict[tuple[int, int], C.CentroidModel | C.MixtureModel]) -> list[dict]:
    """One row of metrics per grid point, with the statistics of its segments, in two passes.

    The first pass yields sizes, means and variances of all clusters, costs, likelihoods, profile sums and
    the contingency of each model with its subsamples' models on all rows; the second, with the means
    known, silhouettes and spreads."""
    specs, views, d = sorted({s for s, _ in models}), len(matrix.views), matrix.width
    k = {key: m.k for key, m in models.items()}

    def first(blocks: list[np.ndarray], group: pd.DataFrame) -> np.ndarray:
        raw = np.column_stack([group[f"{kind}_{c}"].to_numpy("float64") for kind in ("raw", "has") for c in PROFILED])
        raw = np.column_stack([raw, raw[:, : len(PROFILED)] ** 2])
        out = []
        for s in specs:
            own, cost, level = _labels(models[s, 0], blocks[0])
            share = np.eye(k[s, 0])[own]
            out += [share.sum(axis=0), (share.T @ blocks[0]).ravel(), (share.T @ blocks[0] ** 2).ravel(), (share.T @ raw).ravel(), [cost, level]]
            for v in range(1, views):
                other = _labels(models[s, v], blocks[v])[0]
                out.append(np.bincount(own * k[s, v] + other, minlength=k[s, 0] * k[s, v]))
        return np.concatenate(out).astype(float)

    vector, at, found = _pass(matrix, first), 0, []

    def take(*shape: int) -> np.ndarray:
        nonlocal at
        size = int(np.prod(shape))
        at += size
        return vector[at - size : at].reshape(shape)

    for s in specs:
        n = k[s, 0]
        size, sums, squares, raw, (cost, level) = take(n), take(n, d), take(n, d), take(n, 3 * len(PROFILED)), take(2)
        pairs = [take(n, k[s, v]) for v in range(1, views)]
        means = sums / np.maximum(size, 1)[:, None]
        variance = np.maximum(squares / np.maximum(size, 1)[:, None] - means**2, 0).sum(axis=1)
        found.append({"spec": s, "size": size, "means": means, "variance": variance, "raw": raw, "cost": cost, "level": level,
                      "ari": [rand_index(p) for p in pairs]})

    def second(blocks: list[np.ndarray], group: pd.DataFrame) -> np.ndarray:
        out = []
        for f in found:
            own = _labels(models[f["spec"], 0], blocks[0])[0]
            out.append(_spread_and_silhouette(blocks[0], own, f["means"], f["variance"], f["size"]))
        return np.concatenate(out)

    vector, at = _pass(matrix, second), 0
    for f in found:
        f["spread"], f["silhouettes"] = take(len(f["size"])) / np.maximum(f["size"], 1), float(take(1)[0])
    return [_metrics(f, models[f["spec"], 0], matrix.sizes[0]) for f in found]


def _spread_and_silhouette(rows: np.ndarray, own: np.ndarray, means: np.ndarray, variance: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Per cluster the sum of distances to its mean; then the sum of silhouettes by squared distance."""
    gap = np.stack([((rows - m) ** 2).sum(axis=1) for m in means], axis=1)
    at = np.arange(len(rows))
    mean = gap + variance
    mean[:, size == 0] = np.inf
    inside = mean[at, own] * size[own] / np.maximum(size[own] - 1, 1)
    mean[at, own] = np.inf
    near = mean.min(axis=1)
    with np.errstate(invalid="ignore"):
        value = (near - inside) / np.maximum(near, inside)
    value = np.where((size[own] > 1) & np.isfinite(value), value, 0.0)
    return np.append(np.bincount(own, weights=np.sqrt(gap[at, own]), minlength=len(means)), value.sum())


def rand_index(pairs: np.ndarray) -> float:
    """Adjusted Rand index of a contingency table of two labellings."""
    def chosen(n) -> float:
        return float((np.asarray(n, dtype=float) * (np.asarray(n, dtype=float) - 1) / 2).sum())

    cells, rows, columns, total = chosen(pairs), chosen(pairs.sum(axis=1)), chosen(pairs.sum(axis=0)), chosen(pairs.sum())
    expected = rows * columns / total if total else 0.0
    best = (rows + columns) / 2
    return 1.0 if not total or best == expected else (cells - expected) / (best - expected)


def _metrics(f: dict, model, n: int) -> dict:
    there = np.flatnonzero(f["size"] > 0)
    size, means, spread = f["size"][there], f["means"][there], f["spread"][there]
    row = {
        "n_clusters": len(there), "min_size": int(size.min(initial=n)), "max_size": int(size.max(initial=0)),
        "min_share": float(size.min(initial=n) / max(n, 1)), "silhouette": None, "davies_bouldin": None,
        "inertia": None, "bic": None, "aic": None,
        "stability_ari_subsample": float(np.mean(f["ari"])) if f["ari"] else None,
        "stability_ari_subsample_std": float(np.std(f["ari"])) if f["ari"] else None,
        "segments": _segments(f, there, n),
    }
    if 2 <= len(there) < n:
        gap = np.sqrt(((means[:, None] - means[None]) ** 2).sum(axis=2))
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(gap > 0, (spread[:, None] + spread[None]) / gap, 0.0)
        row |= {"silhouette": f["silhouettes"] / n, "davies_bouldin": float(ratio.max(axis=1).mean())}
    if isinstance(model, C.MixtureModel):
        row["bic"], row["aic"] = model.information_criteria(n, float(f["level"]))
    else:
        row["inertia"] = float(f["cost"])
    return row


def _segments(f: dict, there: np.ndarray, n: int) -> list[dict]:
    """Size, share, means and z-scores of the segments, as ``profiles.segment_statistics`` has them."""
    p = len(PROFILED)
    total, known, squares = (f["raw"][:, i * p : (i + 1) * p] for i in range(3))
    with np.errstate(divide="ignore", invalid="ignore"):
        mean, every = total / known, total.sum(axis=0) / known.sum(axis=0)
        deviation = np.sqrt(np.maximum(squares.sum(axis=0) / known.sum(axis=0) - every**2, 0))
        # a constant column has no deviation but for rounding
        z = np.where(deviation > 1e-9 * np.abs(every), (mean - every) / deviation, 0.0)
    return [
        {"segment_id": int(i), "size": int(f["size"][i]), "share": float(f["size"][i] / n),
         **{f"{c}_mean": float(mean[i, j]) if known[i, j] else None for j, c in enumerate(PROFILED)},
         "z_recency_inverted": float(-z[i, 0]), "z_frequency": float(z[i, 1]), "z_monetary": float(z[i, 2])}
        for i in there]
