"""Queries on preparation, clusters, profiles, selection, gates and published segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.contracts import CUSTOMER_SEGMENTS
from buyerlens.functions import scalars as S
from buyerlens.functions.scalars import SEGMENT_DESCRIPTIONS
from buyerlens.operators import cluster_metrics as metrics
from buyerlens.operators import gates, preprocess, profiles, scoring, selection, stability
from buyerlens.operators.quality import contract_expressions
from buyerlens.oracle_base import AS_OF, PRIOR, enriched, features_cte, r6
from buyerlens.oracle_base import rollup as rollup_cte
from buyerlens.plans import feature_table as plan
from buyerlens.registry import register
from buyerlens.registry.features import rounded
from buyerlens.registry.given import CENTRES, LABELS, STAMP, given_model
from buyerlens.registry.published import published
from buyerlens.sources import adapters
from buyerlens.sources.partitions import dataset_summary


def _prepared_cte(suffix: str = "") -> str:
    """CTEs ``stats``, ``z``, ``assigned`` and ``scored`` on top of ``feat``."""
    s = suffix
    logged, linear = preprocess.LOG_COLUMNS, [c for c in preprocess.FEATURE_COLUMNS if c not in preprocess.LOG_COLUMNS]
    columns = [*logged, *linear]
    value = {c: f"ln(1 + greatest(CAST({c} AS DOUBLE), 0))" if c in logged else f"CAST({c} AS DOUBLE)" for c in columns}
    z = ", ".join(
        f"(({value[c]}) - avg({value[c]}) OVER ()) / stddev_pop({value[c]}) OVER () AS z_{c}" for c in columns
    )
    distances = [
        " + ".join(f"(z_{c} - ({m})) * (z_{c} - ({m}))" for c, m in zip(columns, centre)) for centre in CENTRES
    ]
    near = f"least({', '.join(distances)})"
    case = " ".join(f"WHEN {d} <= {near} THEN {k}" for k, d in enumerate(distances))
    label = " ".join(f"WHEN {k} THEN '{v}'" for k, v in LABELS.items())
    return f"""
z{s} AS (SELECT *, {z} FROM feat{s}),
assigned{s} AS (SELECT *, CAST(CASE {case} END AS INTEGER) AS segment_id, {near} AS d2 FROM z{s}),
scored{s} AS (SELECT *, CASE segment_id {label} ELSE concat('cluster_', segment_id) END AS segment_label FROM assigned{s})"""


ONE_PERIOD = features_cte() + "," + _prepared_cte()
TWO_PERIODS = (
    ONE_PERIOD + "," + enriched(PRIOR, "_p") + "," + rollup_cte(PRIOR, "_p") + "," + _prepared_cte("_p")
)


def _features(spark, sf_dir, as_of: str = AS_OF) -> DataFrame:
    return plan.feature_table(adapters.retail(spark, sf_dir), as_of)


def _segments(spark, sf_dir, as_of: str = AS_OF) -> DataFrame:
    features = _features(spark, sf_dir, as_of)
    return scoring.assign_segments(features, given_model(features), scored_at=STAMP, strict=False)


# --- preparation and assignment -----------------------------------------------------

_STATS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {r6(f'median({c})')} AS median, {r6(f'avg({v})')} AS mean, {r6(f'stddev_pop({v})')} AS std FROM feat"
    for c in preprocess.FEATURE_COLUMNS
    for v in [f"ln(1 + greatest({c}, 0))" if c in preprocess.LOG_COLUMNS else c]
)


@register("preprocess_stats", f"WITH {features_cte()} {_STATS}")
def preprocess_stats(spark, sf_dir):
    features = _features(spark, sf_dir)
    return rounded(preprocess.statistics_frame(features, preprocess.fit_preprocessor(features)))


_Z = ", ".join(f"{r6(f'z_{c}')} AS z_{c}" for c in preprocess.FEATURE_COLUMNS)


@register("preprocessed_matrix", f"WITH {ONE_PERIOD} SELECT customer_unique_id, {_Z} FROM z")
def preprocessed_matrix(spark, sf_dir):
    features = _features(spark, sf_dir)
    fitted = preprocess.fit_preprocessor(features)
    return rounded(fitted.transform(features).select("customer_unique_id", *fitted.outputs))


@register("model_frame", f"""WITH {features_cte()}
SELECT customer_unique_id, {", ".join(f"{r6(f'CAST({c} AS DOUBLE)')} AS {c}" for c in preprocess.FEATURE_COLUMNS)} FROM feat""")
def model_frame(spark, sf_dir):
    return rounded(preprocess.select_model_frame(_features(spark, sf_dir), id_column="customer_unique_id"))


@register("model_head", f"""WITH {features_cte()}
SELECT customer_unique_id, {", ".join(f"{r6(f'CAST({c} AS DOUBLE)')} AS {c}" for c in preprocess.FEATURE_COLUMNS)} FROM feat ORDER BY customer_unique_id LIMIT 5""")
def model_head(spark, sf_dir):
    """The rows that a smoke test takes: the first five in the order of their ids."""
    return rounded(scoring.head(preprocess.select_model_frame(_features(spark, sf_dir), id_column="customer_unique_id"), 5))


@register("fixed_centroid_assign", f"WITH {ONE_PERIOD} SELECT customer_unique_id, segment_id, {r6('d2')} AS d2 FROM assigned")
def fixed_centroid_assign(spark, sf_dir):
    features = _features(spark, sf_dir)
    model = given_model(features)
    labelled = model.clusters.with_distance(model.clusters.assign(model.prepare(features)))
    return rounded(labelled.select("customer_unique_id", "segment_id", "d2"))


@register("assign_segments_fixed", f"""WITH {ONE_PERIOD}
SELECT customer_unique_id, as_of_date, recency_days, frequency, {r6('monetary')} AS monetary, r_score, f_score,
  m_score, segment_id, segment_label, 'purchase_segments' AS model_name, '7' AS model_version, feature_set_version
FROM scored""")
def assign_segments_fixed(spark, sf_dir):
    return rounded(_segments(spark, sf_dir))


# --- cluster metrics -----------------------------------------------------------------

def _points(spark, sf_dir) -> tuple[DataFrame, list[str]]:
    dims = adapters.dimension_count(spark, sf_dir)
    return adapters.labelled_points(spark, sf_dir, dims), [f"x{i}" for i in range(dims)]


_POINTS = "pts AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
_CENTRES = """dims AS (SELECT label, i, avg(v[i]) AS m FROM pts, range(1, len(v) + 1) r(i) GROUP BY ALL),
centres AS (SELECT label, list(m ORDER BY i) AS c FROM dims GROUP BY label),
own AS (SELECT p.label, list_distance(p.v, c.c) AS d FROM pts p JOIN centres c ON p.label = c.label)"""
_DB = """spread AS (SELECT label, avg(d) AS s FROM own GROUP BY label),
worst AS (
  SELECT a.label, max((a.s + b.s) / list_distance(ca.c, cb.c)) AS w
  FROM spread a JOIN spread b ON a.label <> b.label
  JOIN centres ca ON ca.label = a.label JOIN centres cb ON cb.label = b.label GROUP BY a.label)"""
# mean distances of each point in "few" to every cluster
_SILHOUETTE_OF = """sizes AS (SELECT label, count(*) AS n FROM few GROUP BY label),
means AS (
  SELECT a.vec_id, a.label AS own, b.label AS other, sum(list_distance(a.v, b.v)) AS total
  FROM few a, few b GROUP BY ALL),
ab AS (
  SELECT vec_id, own, max(CASE WHEN own = other THEN total / nullif(n - 1, 0) END) AS a,
    min(CASE WHEN own <> other THEN total / n END) AS b
  FROM means JOIN sizes ON sizes.label = other GROUP BY ALL),
sil AS (SELECT avg(CASE WHEN a IS NULL THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END) AS silhouette FROM ab)"""
# the reproducible sample of at most 4000 points; and all points, by squared distance
_SILHOUETTE = f"""few AS (
  SELECT * FROM pts QUALIFY row_number() OVER (
    ORDER BY ('0x' || substr(md5('42|' || vec_id), 1, 13))::BIGINT, vec_id::VARCHAR) <= 4000),
{_SILHOUETTE_OF}"""
_SQUARED = f"few AS (SELECT * FROM pts), {_SILHOUETTE_OF.replace('list_distance(a.v, b.v)', 'list_distance(a.v, b.v) ** 2')}"


@register("cluster_distribution", f"SELECT label, size, {r6('size / sum(size) OVER ()')} AS share FROM (SELECT label, count(*) AS size FROM embeddings GROUP BY label)")
def cluster_distribution(spark, sf_dir):
    return rounded(metrics.cluster_distribution(adapters.read_table(spark, sf_dir, "embeddings"), "label"))


@register("inertia", f"WITH {_POINTS}, {_CENTRES} SELECT {r6('sum(d * d)')} AS inertia FROM own")
def inertia(spark, sf_dir):
    points, columns = _points(spark, sf_dir)
    return rounded(metrics.inertia(points, "label", columns))


@register("davies_bouldin", f"WITH {_POINTS}, {_CENTRES}, {_DB} SELECT {r6('avg(w)')} AS davies_bouldin FROM worst")
def davies_bouldin(spark, sf_dir):
    points, columns = _points(spark, sf_dir)
    return rounded(metrics.davies_bouldin(points, "label", columns))


@register("silhouette_euclid", f"WITH {_POINTS}, {_SILHOUETTE} SELECT {r6('silhouette')} AS silhouette FROM sil")
def silhouette_euclid(spark, sf_dir):
    points, columns = _points(spark, sf_dir)
    return rounded(metrics.silhouette(points, "label", columns, "vec_id"))


@register("silhouette_squared", f"WITH {_POINTS}, {_SQUARED} SELECT {r6('silhouette')} AS silhouette FROM sil")
def silhouette_squared(spark, sf_dir):
    points, columns = _points(spark, sf_dir)
    return rounded(metrics.squared_silhouette(points, "label", columns))


@register("cluster_metrics_row", f"""WITH {_POINTS}, {_CENTRES}, {_DB}, {_SQUARED},
n AS (SELECT count(*) AS size FROM pts GROUP BY label)
SELECT (SELECT {r6('silhouette')} FROM sil) AS silhouette, (SELECT {r6('avg(w)')} FROM worst) AS davies_bouldin,
  (SELECT {r6('sum(d * d)')} FROM own) AS inertia, count(*) AS n_clusters, min(size) AS min_size,
  max(size) AS max_size, {r6('min(size) / sum(size)')} AS min_share FROM n""")
def cluster_metrics_row(spark, sf_dir):
    points, columns = _points(spark, sf_dir)
    row = metrics.cluster_metrics(points, "label", columns)
    return rounded(spark.createDataFrame(
        [tuple(row.values())],
        "silhouette double, davies_bouldin double, inertia double, n_clusters bigint, min_size bigint, "
        "max_size bigint, min_share double",
    ))


_ARI = """cells AS (SELECT a, b, CAST(count(*) AS DOUBLE) AS n FROM pairs GROUP BY ALL),
sums AS (
  SELECT (SELECT sum(n * (n - 1) / 2) FROM cells) AS c,
    (SELECT sum(n * (n - 1) / 2) FROM (SELECT sum(n) AS n FROM cells GROUP BY a)) AS ra,
    (SELECT sum(n * (n - 1) / 2) FROM (SELECT sum(n) AS n FROM cells GROUP BY b)) AS rb,
    (SELECT sum(n) * (sum(n) - 1) / 2 FROM cells) AS t),
ari AS (SELECT CASE WHEN (ra + rb) / 2 = ra * rb / t THEN 1.0 ELSE (c - ra * rb / t) / ((ra + rb) / 2 - ra * rb / t) END AS v FROM sums)"""


@register("adjusted_rand", f"""WITH pairs AS (SELECT l_returnflag || l_linestatus AS a, l_linestatus AS b FROM lineitem), {_ARI}
SELECT {r6('v')} AS adjusted_rand FROM ari""")
def adjusted_rand(spark, sf_dir):
    """Agreement of two labellings of the line items."""
    labelled = adapters.read_table(spark, sf_dir, "lineitem").select(
        F.concat("l_returnflag", "l_linestatus").alias("a"), F.col("l_linestatus").alias("b")
    )
    return rounded(metrics.adjusted_rand(labelled, "a", "b"))


@register("contingency", "SELECT l_returnflag AS a, l_linenumber AS b, count(*) AS n FROM lineitem GROUP BY ALL")
def contingency(spark, sf_dir):
    return metrics.contingency(adapters.read_table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linenumber")


@register("period_stability_fixed", f"""WITH {TWO_PERIODS},
pairs AS (SELECT p.segment_id AS a, q.segment_id AS b FROM assigned_p p JOIN assigned q USING (customer_unique_id)), {_ARI}
SELECT CASE WHEN (SELECT count(*) FROM pairs) >= 50 THEN {r6('v')} END AS stability_ari_period,
  CAST((SELECT count(*) FROM pairs) AS DOUBLE) AS stability_period_overlap FROM ari""")
def period_stability_fixed(spark, sf_dir):
    """Both periods under the given centroids, each with its own preparation."""
    return rounded(stability.period_stability(
        _segments(spark, sf_dir, PRIOR), _segments(spark, sf_dir), "customer_unique_id"
    ))


# --- profiles ------------------------------------------------------------------------

def _profiles_sql(source: str, segment: str) -> str:
    means = {c: f"avg({c})" for c in ("recency_days", "frequency", "monetary")}
    z = {
        c: f"({m} - (SELECT avg({c}) FROM {source})) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END FROM {source})"
        for c, m in means.items()
    }
    descriptions = " ".join(
        f"WHEN '{name}' THEN '{text}'" for name, text in SEGMENT_DESCRIPTIONS.items()
    )
    return f"""
prof AS (
  SELECT {segment} AS segment_id, count(*) AS size, count(*) / (SELECT count(*) FROM {source}) AS share,
    {means['recency_days']} AS recency_days_mean, {means['frequency']} AS frequency_mean,
    {means['monetary']} AS monetary_mean, avg(avg_ticket) AS avg_ticket_mean,
    -({z['recency_days']}) AS r, {z['frequency']} AS f, {z['monetary']} AS m
  FROM {source} GROUP BY 1),
based AS (SELECT *, CASE
    WHEN r > 0.25 AND f > 0.25 AND m > 0.25 THEN 'champions' WHEN f > 0.35 AND m > 0 THEN 'loyal_customers'
    WHEN m > 0.45 AND f <= 0.1 THEN 'big_spenders' WHEN r > 0.35 AND f < 0 AND m < 0.35 THEN 'new_customers'
    WHEN r < -0.25 AND f > 0 THEN 'at_risk' WHEN r < -0.25 AND f <= 0 AND m <= 0 THEN 'hibernating'
    ELSE 'need_attention' END AS base FROM prof),
named AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY segment_id) AS nth,
    CASE base {descriptions} END AS description FROM based)
SELECT segment_id, size, {r6('share')} AS share, {r6('recency_days_mean')} AS recency_days_mean,
  {r6('frequency_mean')} AS frequency_mean, {r6('monetary_mean')} AS monetary_mean,
  {r6('avg_ticket_mean')} AS avg_ticket_mean, {r6('r')} AS z_recency_inverted, {r6('f')} AS z_frequency,
  {r6('m')} AS z_monetary, base || CASE WHEN nth > 1 THEN '_' || nth ELSE '' END AS segment_label, description FROM named"""


@register("segment_profiles", f"WITH {ONE_PERIOD}, {_profiles_sql('assigned', 'segment_id')}")
def segment_profiles(spark, sf_dir):
    features = _features(spark, sf_dir)
    return rounded(profiles.build_profiles(given_model(features).assign(features)))


@register("segment_labels", f"WITH {features_cte()}, {_profiles_sql('feat', 'CAST(customer_state AS INTEGER)')}")
def segment_labels(spark, sf_dir):
    """States as segments: many share a base label and are numbered."""
    features = _features(spark, sf_dir).withColumn("segment_id", F.col("customer_state").cast("int"))
    return rounded(profiles.build_profiles(features))


# --- trials, selection and gates -------------------------------------------------------

def trials(spark, sf_dir) -> DataFrame:
    """One trial per supplier, measured on its line items; the nation is the experiment."""
    lines = adapters.read_table(spark, sf_dir, "lineitem")
    groups = lines.groupBy("l_suppkey", "l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("size"),
        F.sum(F.round(F.col("l_discount") * 100).cast("bigint")).alias("discount"),
        F.sum(F.round(F.col("l_tax") * 100).cast("bigint")).alias("tax"),
        F.sum(F.round("l_quantity").cast("bigint")).alias("quantity"),
    )
    total = F.sum("size")
    measured = groups.groupBy("l_suppkey").agg(
        (F.sum("discount") / (total * 100) * 6 - 0.1).alias("silhouette"),
        (F.sum("tax") / (total * 100) * 25).alias("davies_bouldin"),
        (F.sum("quantity") / (total * 50)).alias("stability_ari_subsample"),
        F.count(F.lit(1)).alias("n_clusters"), F.min("size").alias("min_size"), F.max("size").alias("max_size"),
        (F.min("size") / total).alias("min_share"), total.alias("n"),
    )
    suppliers = adapters.read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return measured.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_nationkey").alias("experiment"), F.col("l_suppkey").alias("trial_index"),
        F.element_at(F.array(F.lit("kmeans"), F.lit("minibatch_kmeans"), F.lit("gaussian_mixture")),
                     (F.col("l_suppkey") % 3 + 1).cast("int")).alias("algorithm"),
        "silhouette", "davies_bouldin", "stability_ari_subsample", "n_clusters", "min_size", "max_size",
        "min_share", "n",
    )


_TRIALS = """
g AS (
  SELECT l_suppkey, l_returnflag, l_linestatus, count(*) AS size, sum(CAST(round(l_discount * 100) AS BIGINT)) AS d,
    sum(CAST(round(l_tax * 100) AS BIGINT)) AS t, sum(CAST(round(l_quantity) AS BIGINT)) AS q
  FROM lineitem GROUP BY ALL),
trials AS (
  SELECT s_nationkey AS experiment, l_suppkey AS trial_index,
    ['kmeans', 'minibatch_kmeans', 'gaussian_mixture'][l_suppkey % 3 + 1] AS algorithm,
    sum(d)::DOUBLE / (sum(size) * 100)::DOUBLE * 6 - 0.1::DOUBLE AS silhouette,
    sum(t)::DOUBLE / (sum(size) * 100)::DOUBLE * 25 AS davies_bouldin,
    sum(q)::DOUBLE / (sum(size) * 50)::DOUBLE AS stability_ari_subsample,
    count(*) AS n_clusters, min(size) AS min_size, max(size) AS max_size,
    min(size)::DOUBLE / sum(size)::DOUBLE AS min_share, CAST(sum(size) AS BIGINT) AS n
  FROM g JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_suppkey, s_nationkey),
gated AS (
  SELECT *, silhouette >= 0.2::DOUBLE AS g1, n_clusters BETWEEN 3 AND 10 AS g2, min_size >= 20 AS g3,
    min_share >= 0.002::DOUBLE AS g4, stability_ari_subsample >= 0.5::DOUBLE AS g5,
    0.45::DOUBLE * silhouette + 0.2::DOUBLE / (1::DOUBLE + greatest(davies_bouldin, 0::DOUBLE)) + 0.35::DOUBLE * stability_ari_subsample AS score
  FROM trials),
winners AS (
  SELECT *, g1 AND g2 AND g3 AND g4 AND g5 AS gates_passed,
    count(*) FILTER (WHERE g1 AND g2 AND g3 AND g4 AND g5) OVER (PARTITION BY experiment) AS n_passing_gates
  FROM gated QUALIFY row_number() OVER (PARTITION BY experiment
    ORDER BY (g1 AND g2 AND g3 AND g4 AND g5) DESC, score DESC, trial_index) = 1)"""


@register("trial_gates", f"""WITH {_TRIALS}
SELECT experiment, trial_index, "check", passed, {r6('value')} AS value FROM (
  SELECT experiment, trial_index, 'silhouette_min' AS "check", g1 AS passed, silhouette AS value FROM gated
  UNION ALL SELECT experiment, trial_index, 'segment_count_between', g2, n_clusters FROM gated
  UNION ALL SELECT experiment, trial_index, 'no_empty_segment', g3, min_size FROM gated
  UNION ALL SELECT experiment, trial_index, 'min_cluster_share', g4, min_share FROM gated
  UNION ALL SELECT experiment, trial_index, 'ari_subsample_min', g5, stability_ari_subsample FROM gated)""")
def trial_gates(spark, sf_dir):
    return rounded(selection.trial_checks(trials(spark, sf_dir), ["experiment", "trial_index"]))


@register("trial_scores", f"""WITH {_TRIALS} SELECT experiment, trial_index, {r6('score')} AS composite_score FROM gated""")
def trial_scores(spark, sf_dir):
    scored = selection.score_trials(trials(spark, sf_dir))
    return rounded(scored.select("experiment", "trial_index", "composite_score"))


@register("run_names", f"""WITH {_TRIALS}
SELECT experiment, trial_index, concat(algorithm, '_k', n_clusters, '_min_size=', min_size, '_n=', n) AS run_name FROM trials""")
def run_names(spark, sf_dir):
    """Names of runs from their algorithm, clusters and parameters."""
    named = S.run_name(F.col("algorithm"), F.col("n_clusters"), F.create_map(
        F.lit("min_size"), F.col("min_size").cast("string"), F.lit("n"), F.col("n").cast("string")))
    return trials(spark, sf_dir).select("experiment", "trial_index", named.alias("run_name"))


@register("trial_metrics", f"""WITH {_TRIALS}
SELECT experiment, trial_index, metric, {r6('value')} AS value FROM (
  SELECT experiment, trial_index, 'silhouette' AS metric, silhouette AS value FROM trials
  UNION ALL SELECT experiment, trial_index, 'davies_bouldin', davies_bouldin FROM trials
  UNION ALL SELECT experiment, trial_index, 'excess', ln(n_clusters - 5) FROM trials WHERE n_clusters > 5)""")
def trial_metrics(spark, sf_dir):
    """Finite metrics only: the logarithm of a non-positive excess is left out."""
    extended = trials(spark, sf_dir).withColumn("excess", F.ln(F.col("n_clusters") - 5))
    return rounded(selection.finite_metrics(
        extended, ["experiment", "trial_index"], ["silhouette", "davies_bouldin", "excess"]
    ))


@register("trial_comparison", f"""WITH {_TRIALS}
SELECT experiment, trial_index, algorithm, n_clusters, {r6('silhouette')} AS silhouette, {r6('davies_bouldin')} AS davies_bouldin,
  CAST(NULL AS DOUBLE) AS inertia, {r6('stability_ari_subsample')} AS stability_ari_subsample,
  {r6('score')} AS composite_score, g1 AND g2 AND g3 AND g4 AND g5 AS gates_passed FROM gated""")
def trial_comparison(spark, sf_dir):
    return rounded(selection.comparison_table(
        trials(spark, sf_dir).withColumn("inertia", F.lit(None).cast("double")), ["experiment"]
    ))


@register("select_candidate", f"""WITH {_TRIALS}
SELECT experiment, trial_index, algorithm, n_clusters, {r6('score')} AS composite_score, gates_passed, n_passing_gates,
  CASE WHEN n_passing_gates > 0 THEN 'gates_passed' ELSE 'best_effort' END AS selection_pool FROM winners""")
def select_candidate(spark, sf_dir):
    """The winner of every experiment."""
    return rounded(selection.select_candidate(trials(spark, sf_dir), ["experiment"]).select(
        "experiment", "trial_index", "algorithm", "n_clusters", "composite_score", "gates_passed",
        "n_passing_gates", "selection_pool",
    ))


def promotions(spark, sf_dir) -> DataFrame:
    """Winners as candidates; the champion of a nation is its trial with the lowest
    Davies-Bouldin, and nations whose candidate is that trial have none."""
    every = trials(spark, sf_dir)
    n = F.col("n")
    candidates = selection.select_candidate(every, ["experiment"]).withColumns({
        "data_ok": F.col("max_size") >= F.col("min_size") + 1, "data_detail": F.format_string("rows=%d", n),
        "signature_ok": n % 7 != 0, "integration_ok": n % 5 != 0, "smoke_ok": n % 2 == 0,
    })
    champions = every.groupBy("experiment").agg(
        F.min_by(F.struct("trial_index", "silhouette", "davies_bouldin"), F.struct("davies_bouldin", "trial_index")).alias("c")
    ).select("experiment", F.col("c.trial_index").alias("champion_trial"), "c.silhouette", "c.davies_bouldin")
    others = champions.join(
        candidates.select("experiment", F.col("trial_index").alias("champion_trial")),
        ["experiment", "champion_trial"], "left_anti",
    )
    return gates.evaluate_promotion(gates.with_champion(candidates, others, ["experiment"]))


_PROMOTED = f"""WITH {_TRIALS},
champ AS (
  SELECT experiment, trial_index, silhouette AS cs, davies_bouldin AS cd FROM trials
  QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY davies_bouldin, trial_index) = 1),
cand AS (
  SELECT w.*, c.cs, c.cd, max_size >= min_size + 1 AS data_failure,
    silhouette >= 0.2::DOUBLE AND (c.cs IS NULL OR (c.cs - silhouette <= 0.05::DOUBLE AND davies_bouldin - c.cd <= 0.4::DOUBLE)) AS metric_regression,
    g2 AND g3 AND g4 AND g5 AS unstable_or_empty_clusters, n % 7 <> 0 AS signature_incompatible,
    n % 5 <> 0 AND n % 2 = 0 AS integration_failure, n % 2 = 0 AS smoke
  FROM winners w LEFT JOIN champ c ON w.experiment = c.experiment AND w.trial_index <> c.trial_index),
decided AS (
  SELECT *, concat_ws(',', CASE WHEN NOT data_failure THEN 'data_failure' END,
    CASE WHEN NOT metric_regression THEN 'metric_regression' END,
    CASE WHEN NOT unstable_or_empty_clusters THEN 'unstable_or_empty_clusters' END,
    CASE WHEN NOT signature_incompatible THEN 'signature_incompatible' END,
    CASE WHEN NOT integration_failure THEN 'integration_failure' END) AS failed FROM cand)"""


@register("promotion_gates", f"""{_PROMOTED}
SELECT experiment, trial_index, name, passed, CASE WHEN failed = '' THEN 'approved' ELSE 'rejected' END AS decision, failed
FROM (UNPIVOT decided ON data_failure, metric_regression, unstable_or_empty_clusters, signature_incompatible,
  integration_failure, smoke INTO NAME name VALUE passed)""")
def promotion_gates(spark, sf_dir):
    evaluated = promotions(spark, sf_dir).withColumn("failed", F.array_join("blocking_failed", ","))
    return gates.check_rows(evaluated, ["experiment", "trial_index", "decision", "failed"]).drop("detail")


def _up(number: str) -> str:
    """A number whose exact half-way cases, which are binary fractions, are printed away from zero, as the JVM does it."""
    return f"(CASE WHEN ({number}) * 65536 = floor(({number}) * 65536) THEN ({number}) + sign({number}) * 1e-12 ELSE {number} END)"


@register("gate_tags", f"""{_PROMOTED}, tags AS (
  SELECT experiment, concat('quality_gate_', name) AS tag, CASE WHEN passed THEN 'pass' ELSE 'fail' END AS value
  FROM (UNPIVOT decided ON data_failure, metric_regression, unstable_or_empty_clusters, signature_incompatible,
    integration_failure, smoke INTO NAME name VALUE passed)
  UNION ALL SELECT experiment, 'quality_gate_decision', CASE WHEN failed = '' THEN 'approved' ELSE 'rejected' END FROM decided
  UNION ALL SELECT experiment, 'quality_gate_approved', CASE WHEN failed = '' THEN 'true' ELSE 'false' END FROM decided
  UNION ALL SELECT experiment, 'quality_gate_blocking_failed', CASE WHEN failed = '' THEN '[]'
    ELSE concat('["', replace(failed, ',', '", "'), '"]') END FROM decided
  UNION ALL SELECT experiment, 'quality_gate_data_failure_detail', concat('rows=', n) FROM decided
  UNION ALL SELECT experiment, 'quality_gate_metric_regression_detail',
    CASE WHEN cs IS NULL THEN printf('sem champion prévio; silhouette=%.3f (min 0.2)', {_up('silhouette')})
      ELSE printf('sil %.3f vs champion %.3f (drop=%.3f); db Δ=%.3f', {_up('silhouette')}, {_up('cs')}, {_up('cs - silhouette')}, {_up('davies_bouldin - cd')}) END FROM decided
  UNION ALL SELECT experiment, 'quality_gate_unstable_or_empty_clusters_detail',
    printf('k=%d min_size=%d min_share=%.4f ari=%.3f', n_clusters, min_size, {_up('min_share')}, {_up('stability_ari_subsample')}) FROM decided
  UNION ALL SELECT experiment, 'quality_gate_signature_incompatible_detail', 'assinatura ok' FROM decided
  UNION ALL SELECT experiment, 'quality_gate_smoke_detail', 'smoke ok' FROM decided
  UNION ALL SELECT experiment, 'quality_gate_integration_failure_detail',
    CASE WHEN NOT smoke AND n % 5 <> 0 THEN 'integração ok; smoke falhou' ELSE 'integração ok' END FROM decided)
SELECT experiment, tag, value FROM tags""")
def gate_tags(spark, sf_dir):
    """All fifteen tags of every candidate."""
    return gates.gate_tags(promotions(spark, sf_dir), ["experiment"])


def _periods(spark, sf_dir) -> list[DataFrame]:
    """Both stored dates, the earlier one first."""
    store = published(spark, sf_dir)
    live = store.snapshot().live
    return [store.read(live[day]) for day in sorted(live)]


# --- published segments ------------------------------------------------------------------

@register("segment_lookup", f"""WITH {ONE_PERIOD}
SELECT c.customer_unique_id, segment_id, segment_label, as_of_date,
  CASE WHEN segment_id IS NOT NULL THEN '{STAMP}' END AS updated_at,
  CASE WHEN segment_id IS NOT NULL THEN 'purchase_segments' END AS model_name,
  CASE WHEN segment_id IS NOT NULL THEN '7' END AS model_version, feature_set_version
FROM (SELECT DISTINCT customer_unique_id FROM cust) c LEFT JOIN scored s ON c.customer_unique_id = s.customer_unique_id""")
def segment_lookup(spark, sf_dir):
    """Every known customer; those without a purchase in the window have no segment."""
    store, ids = published(spark, sf_dir), adapters.customers(spark, sf_dir)
    return scoring.segment_lookup(ids, store.matching(ids, store.snapshot().current))


@register("segment_lookup_few", f"""WITH {ONE_PERIOD}, busy AS (
  SELECT c_nationkey, o_custkey FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) JOIN customer ON o_custkey = c_custkey
  QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, o_custkey) = 1),
ids AS (SELECT DISTINCT customer_unique_id FROM cust JOIN busy ON customer_id = CAST(o_custkey AS VARCHAR))
SELECT i.customer_unique_id, segment_id, segment_label, as_of_date,
  CASE WHEN segment_id IS NOT NULL THEN '{STAMP}' END AS updated_at,
  CASE WHEN segment_id IS NOT NULL THEN 'purchase_segments' END AS model_name,
  CASE WHEN segment_id IS NOT NULL THEN '7' END AS model_version, feature_set_version
FROM ids i LEFT JOIN scored s ON i.customer_unique_id = s.customer_unique_id""")
def segment_lookup_few(spark, sf_dir):
    """The customer with most orders of each nation: few ids, which reach the scan."""
    orders = adapters.read_table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).count()
    homes = adapters.read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    busy = orders.join(homes, "c_custkey").groupBy("c_nationkey").agg(
        F.max_by("c_custkey", F.struct("count", -F.col("c_custkey"))).cast("string").alias("customer_id"))
    ids = adapters.customers(spark, sf_dir).join(busy, "customer_id", "left_semi")
    store = published(spark, sf_dir)
    return scoring.segment_lookup(ids, store.matching(ids, store.snapshot().current))


@register("segments_health", f"""WITH {ONE_PERIOD}
SELECT 'ok' AS status, true AS scores_available, max(as_of_date) AS as_of_date, 'purchase_segments' AS model_name,
  '7' AS model_version, count(*) AS n_customers, count(DISTINCT segment_id) AS n_segments, '{STAMP}' AS scored_at FROM scored""")
def segments_health(spark, sf_dir):
    return scoring.segments_health(published(spark, sf_dir).current())


_BOTH = "history AS (SELECT as_of_date, customer_unique_id, segment_id, segment_label FROM scored UNION ALL SELECT as_of_date, customer_unique_id, segment_id, segment_label FROM scored_p)"


@register("segment_distribution_history", f"""WITH {TWO_PERIODS}, {_BOTH}
SELECT as_of_date, segment_label, size, {r6('size / sum(size) OVER (PARTITION BY as_of_date)')} AS share
FROM (SELECT as_of_date, segment_label, count(*) AS size FROM history GROUP BY 1, 2)""")
def segment_distribution_history(spark, sf_dir):
    return rounded(scoring.distribution_history(published(spark, sf_dir).all()))


@register("dataset_summary", f"""WITH {TWO_PERIODS}, {_BOTH}
SELECT 'customer_segments' AS dataset, '7' AS version, as_of_date, count(*) AS row_count, count(DISTINCT segment_id) AS n_segments
FROM history GROUP BY ALL""")
def summary(spark, sf_dir):
    return dataset_summary(published(spark, sf_dir).all(), "customer_segments", "model_version")


@register("segment_catalogue", f"""WITH {TWO_PERIODS}, {_BOTH}
SELECT as_of_date AS "partition", count(*) AS row_count, true AS passed, as_of_date = '{AS_OF}' AS is_current,
  '7' AS model_version FROM history GROUP BY as_of_date""")
def segment_catalogue(spark, sf_dir):
    """Stored dates, their rows and the published one, from the commits alone."""
    seen = published(spark, sf_dir).snapshot()
    rows = [(c["partition"], c["row_count"], c["passed"], c["data"] == seen.current["data"], c["facts"]["version"]) for c in seen.live.values()]
    return spark.createDataFrame(rows, "partition string, row_count long, passed boolean, is_current boolean, model_version string")


@register("segment_migration", f"""WITH {TWO_PERIODS}
SELECT p.segment_label AS from_label, q.segment_label AS to_label, count(*) AS n
FROM scored_p p FULL JOIN scored q ON p.customer_unique_id = q.customer_unique_id GROUP BY ALL""")
def segment_migration(spark, sf_dir):
    return scoring.segment_migration(*_periods(spark, sf_dir))


@register("share_drift", f"""WITH {TWO_PERIODS},
b AS (SELECT segment_label, count(*) / sum(count(*)) OVER () AS s FROM scored_p GROUP BY 1),
a AS (SELECT segment_label, count(*) / sum(count(*)) OVER () AS s FROM scored GROUP BY 1)
SELECT coalesce(a.segment_label, b.segment_label) AS segment_label, {r6('coalesce(b.s, 0)')} AS share_before,
  {r6('coalesce(a.s, 0)')} AS share_after, {r6('coalesce(a.s, 0) - coalesce(b.s, 0)')} AS delta
FROM a FULL JOIN b ON a.segment_label = b.segment_label""")
def share_drift(spark, sf_dir):
    return rounded(scoring.share_drift(*_periods(spark, sf_dir)))


@register("campaign_list", f"WITH {ONE_PERIOD} SELECT customer_unique_id, segment_label FROM scored WHERE segment_label = 'champions'")
def campaign_list(spark, sf_dir):
    return scoring.campaign_list(published(spark, sf_dir).current(), "champions").select("customer_unique_id", "segment_label")


@register("segment_contract", f"""WITH {ONE_PERIOD}, src AS (SELECT * FROM scored),
facts AS (SELECT count(*) AS n, count(DISTINCT segment_id) AS k FROM src),
small AS (SELECT min(n) AS m FROM (SELECT count(*) AS n FROM src GROUP BY segment_id))
SELECT 'one_row_per_customer' AS "check", 'error' AS severity, 0.0::DOUBLE AS measure, true AS passed
UNION ALL SELECT 'segment_coverage', 'error', 1.0, true
UNION ALL SELECT 'min_customers', 'warn', n::DOUBLE, n >= 1000 FROM facts
UNION ALL SELECT 'segment_cardinality', 'error', k::DOUBLE, k BETWEEN 3 AND 10 FROM facts
UNION ALL SELECT 'no_empty_segment', 'warn', m::DOUBLE, m >= 50 FROM small
UNION ALL SELECT 'freshness_48h', 'sla', 41.0, true""")
def segment_contract(spark, sf_dir):
    """Declared checks of the segments table, 41 hours after scoring."""
    return contract_expressions(_segments(spark, sf_dir), CUSTOMER_SEGMENTS, "TIMESTAMP '2001-08-08 00:00:00'")
