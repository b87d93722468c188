"""Queries on fitted clusterings, from given starts and a given number of rounds, so that SQL can follow them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.operators import cluster_metrics as metrics
from buyerlens.operators import preprocess, together
from buyerlens.oracle_base import AS_OF, features_cte, r6
from buyerlens.plans import feature_table as plan
from buyerlens.plans import training
from buyerlens.registry import register
from buyerlens.registry.features import rounded
from buyerlens.registry.given import CENTRES
from buyerlens.registry.models import _ARI, _CENTRES, _DB, _SQUARED, _profiles_sql
from buyerlens.sources import adapters

STARTS = [*CENTRES, [0.2, 0.3, 0.4, 0.1, -0.3, 0.6], [-0.3, -0.2, -0.6, -0.9, 1.2, -0.3]]
ROUNDS = 3
BATCH = 1024
SEED, SUBSAMPLES, FRACTION = 42, training.STABILITY["n_subsamples"], training.STABILITY["fraction"]


def _features(spark, sf_dir) -> DataFrame:
    return plan.feature_table(adapters.retail(spark, sf_dir), AS_OF)


# --- the same in SQL ---------------------------------------------------------------------------

_LOGGED = preprocess.LOG_COLUMNS
_COLUMNS = [*_LOGGED, *[c for c in preprocess.FEATURE_COLUMNS if c not in _LOGGED]]
_VALUES = {c: f"ln(1 + greatest(CAST({c} AS DOUBLE), 0))" if c in _LOGGED else f"CAST({c} AS DOUBLE)" for c in _COLUMNS}
_D = len(_COLUMNS)


def _position(seed: int) -> str:
    return f"('0x' || substr(md5('{seed}|' || customer_unique_id), 1, 13))::BIGINT"


def _views(n: int) -> str:
    """CTEs ``view0`` to ``view<n>``: id, v, inside and, of those inside, the batch in hash order."""
    out = []
    for i in range(n + 1):
        inside = "true" if i == 0 else (
            f"row_number() OVER (ORDER BY {_position(SEED + i - 1)}, customer_unique_id) <= greatest(CAST(floor(count(*) OVER () * {FRACTION}::DOUBLE) AS BIGINT), 2)")
        z = ", ".join(
            f"({_VALUES[c]} - avg({_VALUES[c]}) FILTER (WHERE inside) OVER ()) / stddev_pop({_VALUES[c]}) FILTER (WHERE inside) OVER ()" for c in _COLUMNS)
        out.append(f"""view{i} AS MATERIALIZED (
  SELECT customer_unique_id AS id, [{z}] AS v, inside, CASE WHEN inside THEN
    (row_number() OVER (PARTITION BY inside ORDER BY {_position(SEED)}, customer_unique_id) - 1) // {BATCH} END AS b
  FROM (SELECT *, {inside} AS inside FROM feat))""")
    return ", ".join(out)


def _start(k: int) -> str:
    return f"{STARTS[:k]}::DOUBLE[][]"


_NEAREST = "list_position(ds, list_min(ds))"


def _lloyd(name: str, view: str, k: int, rounds: int = ROUNDS) -> str:
    """A recursive table of centres ``cs``; rows without a point keep the centres that nothing is near to."""
    new = ", ".join(f"coalesce(avg(v[{i}]), any_value(old[{i}]))" for i in range(1, _D + 1))
    return f"""{name}(r, cs) AS (
  SELECT 0, {_start(k)}
  UNION ALL SELECT r + 1, list(c ORDER BY label) FROM (
    SELECT r, label, [{new}] AS c FROM (
      SELECT r, v, coalesce(kept, {_NEAREST}) AS label, CASE WHEN kept IS NOT NULL THEN cs[kept] END AS old FROM (
        SELECT s.r, s.cs, p.v, p.kept, list_transform(s.cs, lambda c: list_distance(c, p.v)) AS ds
        FROM {name} s, (SELECT v, NULL::BIGINT AS kept FROM {view} WHERE inside UNION ALL SELECT NULL, unnest(range(1, {k + 1}))) p
        WHERE s.r < {rounds}))
    GROUP BY r, label) GROUP BY r)"""


def _batches(name: str, view: str, k: int, rounds: int = ROUNDS) -> str:
    """The centres after each batch, for tables of one group."""
    mixed = ", ".join(f"(1 - count(v) / (any_value(n) + count(v))) * any_value(old[{i}]) + count(v) / (any_value(n) + count(v)) * avg(v[{i}])" for i in range(1, _D + 1))
    return f"""{name}(r, cs, cn) AS (
  SELECT 0, {_start(k)}, list_transform(range({k}), lambda x: 0::DOUBLE)
  UNION ALL SELECT r + 1, list(c ORDER BY label), list(seen ORDER BY label) FROM (
    SELECT r, label, CASE WHEN count(v) = 0 THEN any_value(old) ELSE [{mixed}] END AS c, any_value(n) + count(v) AS seen FROM (
      SELECT r, v, coalesce(kept, {_NEAREST}) AS label, CASE WHEN kept IS NOT NULL THEN cs[kept] END AS old,
        CASE WHEN kept IS NOT NULL THEN cn[kept] END AS n FROM (
        SELECT s.r, s.cs, s.cn, p.v, p.kept, list_transform(s.cs, lambda c: list_distance(c, p.v)) AS ds
        FROM {name} s, (SELECT v, b, NULL::BIGINT AS kept FROM {view} WHERE inside UNION ALL SELECT NULL, NULL, unnest(range(1, {k + 1}))) p
        WHERE s.r < {rounds} * (SELECT max(b) + 1 FROM {view}) AND (p.b IS NULL OR p.b = s.r % (SELECT max(b) + 1 FROM {view}))))
    GROUP BY r, label) GROUP BY r)"""


_FLOOR, _EPS = "1e-6::DOUBLE", "2.220446049250313e-15::DOUBLE"


def _log_densities(k: int) -> str:
    gaps = " + ".join(f"(v[{i}] - m[j][{i}]) * (v[{i}] - m[j][{i}]) / s[j][{i}] + ln(2 * pi() * s[j][{i}])" for i in range(1, _D + 1))
    return f"list_transform(range(1, {k + 1}), lambda j: ln(w[j]) - 0.5 * ({gaps}))"


def _mixture(name: str, view: str, k: int, rounds: int = ROUNDS) -> str:
    """Weights, means and variances after each round; the first ones are those of the nearest given centre."""
    means = ", ".join(f"sum(p * v[{i}]) / (sum(p) + {_EPS})" for i in range(1, _D + 1))
    spread = ", ".join(
        f"greatest(sum(p * v[{i}] * v[{i}]) / (sum(p) + {_EPS}) - (sum(p * v[{i}]) / (sum(p) + {_EPS})) ** 2, 0) + {_FLOOR}" for i in range(1, _D + 1))

    def maximised(rows: str) -> str:
        return f"""SELECT r, list_transform(mass, lambda x: x / list_sum(mass)), m, s FROM (
      SELECT r, list(mass ORDER BY j) AS mass, list(mu ORDER BY j) AS m, list(va ORDER BY j) AS s FROM (
        SELECT r, j, sum(p) + {_EPS} AS mass, [{means}] AS mu, [{spread}] AS va FROM ({rows}) GROUP BY r, j) GROUP BY r)"""

    hard = f"""SELECT 0 AS r, j, v, (j = {_NEAREST})::INT::DOUBLE AS p
          FROM (SELECT v, list_transform({_start(k)}, lambda c: list_distance(c, v)) AS ds FROM {view} WHERE inside), range(1, {k + 1}) t(j)"""
    soft = f"""SELECT r + 1 AS r, j, v, exp(ls[j] - list_max(ls) - ln(list_sum(list_transform(ls, lambda x: exp(x - list_max(ls)))))) AS p
          FROM (SELECT q.r, x.v, {_log_densities(k)} AS ls FROM {name} q, (SELECT v FROM {view} WHERE inside) x WHERE q.r < {rounds}), range(1, {k + 1}) t(j)"""
    return f"""{name}(r, w, m, s) AS (
  {maximised(hard)}
  UNION ALL {maximised(soft)})"""


_FITTED = {"kmeans": _lloyd, "minibatch_kmeans": _batches, "gaussian_mixture": _mixture}


def _labelled(name: str, algorithm: str, fit: str, view: str, k: int) -> str:
    """CTE of all rows of a view: id, v, label and, by algorithm, squared distance or log-likelihood."""
    if algorithm == "gaussian_mixture":
        rows = f"SELECT id, v, {_log_densities(k)} AS ls FROM {view}, (SELECT * FROM {fit} ORDER BY r DESC LIMIT 1)"
        return f"""{name} AS MATERIALIZED (SELECT id, v, list_position(ls, list_max(ls)) - 1 AS label,
  list_max(ls) + ln(list_sum(list_transform(ls, lambda x: exp(x - list_max(ls))))) AS measure FROM ({rows}))"""
    rows = f"SELECT id, v, list_transform(cs, lambda c: list_distance(c, v)) AS ds FROM {view}, (SELECT * FROM {fit} ORDER BY r DESC LIMIT 1)"
    return f"{name} AS MATERIALIZED (SELECT id, v, {_NEAREST} - 1 AS label, list_min(ds) ** 2 AS measure FROM ({rows}))"


def _one(algorithm: str, k: int) -> str:
    """Oracle of one fit: sizes and mean squared distance to the own mean."""
    return f"""WITH RECURSIVE {features_cte()}, {_views(0)}, {_FITTED[algorithm]("fit", "view0", k)}, {_labelled("pts", algorithm, "fit", "view0", k)}, {_CENTRES}
SELECT CAST(label AS INTEGER) AS segment_id, count(*) AS size, {r6('avg(d * d)')} AS mean_d2 FROM own GROUP BY label"""


def _fit(spark, sf_dir, algorithm: str, k: int = 4) -> DataFrame:
    features = _features(spark, sf_dir)
    matrix = together.prepared(features, training.ID, seed=SEED)
    members = together.given_starts(matrix, [{"algorithm": algorithm, "n_clusters": k, "params": {}}], STARTS)
    model = together.best_models(matrix, together.fit_all(matrix, members, ROUNDS))[0, 0]
    prepared = matrix.views[0]
    labelled = metrics.with_own_centroid(model.assign(prepared.transform(features)), "segment_id", prepared.outputs)
    return rounded(labelled.groupBy(F.col("label").alias("segment_id")).agg(
        F.count(F.lit(1)).alias("size"), F.avg("d2").alias("mean_d2")))


@register("kmeans_fit", _one("kmeans", 4))
def kmeans_fit(spark, sf_dir):
    return _fit(spark, sf_dir, "kmeans")


@register("minibatch_kmeans_fit", _one("minibatch_kmeans", 4))
def minibatch_kmeans_fit(spark, sf_dir):
    return _fit(spark, sf_dir, "minibatch_kmeans")


@register("gmm_diag_fit", _one("gaussian_mixture", 4))
def gmm_diag_fit(spark, sf_dir):
    return _fit(spark, sf_dir, "gaussian_mixture")


# --- the search ------------------------------------------------------------------------------

_SPECS = list(training.search_space(training.SEARCH))


def _trial(t: int, spec: dict) -> tuple[str, str]:
    """The CTEs of one grid point on all views, and its trial row."""
    algorithm, k = spec["algorithm"], spec["n_clusters"]
    ctes = []
    for v in range(SUBSAMPLES + 1):
        ctes += [_FITTED[algorithm](f"fit{t}_{v}", f"view{v}", k), _labelled(f"lab{t}_{v}", algorithm, f"fit{t}_{v}", f"view{v}", k)]
    ctes.append(f"""measured{t} AS (WITH pts AS (SELECT id AS vec_id, label, v FROM lab{t}_0), {_CENTRES}, {_DB}, {_SQUARED}
  SELECT (SELECT silhouette FROM sil) AS silhouette, (SELECT avg(w) FROM worst) AS davies_bouldin)""")
    aris = " UNION ALL ".join(
        f"SELECT v FROM (WITH pairs AS (SELECT a.label AS a, b.label AS b FROM lab{t}_0 a JOIN lab{t}_{v} b ON a.id = b.id), {_ARI} SELECT v FROM ari)"
        for v in range(1, SUBSAMPLES + 1))
    ctes.append(f"ari{t} AS ({aris})")
    likelihood, parameters = f"(SELECT sum(measure) FROM lab{t}_0)", 2 * k * _D + k - 1
    mixture = algorithm == "gaussian_mixture"
    cost = "CAST(NULL AS DOUBLE)" if mixture else r6(likelihood)
    # sums of logs in the thousands: three places
    bic, aic = (
        f"round({p} - 2 * {likelihood} + 1e-9, 3)" if mixture else "CAST(NULL AS DOUBLE)"
        for p in (f"{parameters} * ln((SELECT count(*) FROM lab{t}_0))", f"2 * {parameters}"))
    row = f"""SELECT {t} AS trial_index, '{algorithm}' AS algorithm, CAST(count(*) AS INTEGER) AS n_clusters, '{spec["run_name"]}' AS run_name,
  (SELECT {r6('silhouette')} FROM measured{t}) AS silhouette, (SELECT {r6('davies_bouldin')} FROM measured{t}) AS davies_bouldin,
  {cost} AS inertia, {bic} AS bic, {aic} AS aic, min(size) AS min_size, max(size) AS max_size, {r6('min(size) / sum(size)')} AS min_share,
  (SELECT {r6('avg(v)')} FROM ari{t}) AS stability_ari_subsample,
  (SELECT {r6('stddev_pop(v)')} FROM ari{t}) AS stability_ari_subsample_std
FROM (SELECT count(*) AS size FROM lab{t}_0 GROUP BY label)"""
    return ", ".join(ctes), row


_TRIAL_SQL = [_trial(t, spec) for t, spec in enumerate(_SPECS)]
_BASE = f"WITH RECURSIVE {features_cte()}, {_views(SUBSAMPLES)}"


def _search(spark, sf_dir) -> training.Search:
    return training.search_clusters(_features(spark, sf_dir), seed=SEED, centres=STARTS, rounds=ROUNDS)


@register("cluster_search", f"{_BASE}, {', '.join(ctes for ctes, _ in _TRIAL_SQL)} {' UNION ALL '.join(row for _, row in _TRIAL_SQL)}")
def cluster_search(spark, sf_dir):
    """The whole grid: nine fits and their subsamples' fits in shared passes."""
    trials = _search(spark, sf_dir).trials.drop("params")
    return rounded(trials).withColumns({c: F.round(F.col(c) + 1e-9, 3) for c in ("bic", "aic")})


def _profile_rows(t: int) -> str:
    source = f"named_rows{t} AS (SELECT f.*, CAST(l.label AS INTEGER) AS segment_id FROM feat f JOIN lab{t}_0 l ON f.customer_unique_id = l.id)"
    return f"SELECT {t} AS trial_index, * FROM (WITH {source}, {_profiles_sql(f'named_rows{t}', 'segment_id')})"


_LABELLINGS = ", ".join(
    f"{_FITTED[s['algorithm']](f'fit{t}_0', 'view0', s['n_clusters'])}, {_labelled(f'lab{t}_0', s['algorithm'], f'fit{t}_0', 'view0', s['n_clusters'])}"
    for t, s in enumerate(_SPECS))


@register("trial_profiles", f"WITH RECURSIVE {features_cte()}, {_views(0)}, {_LABELLINGS} {' UNION ALL '.join(map(_profile_rows, range(len(_SPECS))))}")
def trial_profiles(spark, sf_dir):
    """The labelled segments of every trial."""
    return rounded(_search(spark, sf_dir).profiles)


@register("subsample_stability", f"""{_BASE}, {_TRIAL_SQL[0][0]}
SELECT stability_ari_subsample, stability_ari_subsample_std FROM ({_TRIAL_SQL[0][1]})""")
def subsample_stability(spark, sf_dir):
    """The first grid point alone, with its subsamples."""
    found = training.search_clusters(_features(spark, sf_dir), {"kmeans": {"n_clusters": [4]}}, seed=SEED, centres=STARTS, rounds=ROUNDS)
    return rounded(found.trials.select("stability_ari_subsample", "stability_ari_subsample_std"))
