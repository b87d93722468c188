"""Search over clusterings, selection of a candidate and the gate run."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from buyerlens.operators import quality, together
from buyerlens.operators.cluster_metrics import cluster_metrics
from buyerlens.operators.clustering import MixtureModel, known_algorithm
from buyerlens.operators.gates import PromotionPolicy, evaluate_promotion, with_champion
from buyerlens.operators.profiles import label_segments
from buyerlens.operators.scoring import SegmentModel, integration_probe, signature_compatible, smoke_predict
from buyerlens.operators.selection import TrialGates, select_candidate, with_lineage
from buyerlens.operators.stability import period_stability, subsample_stability
from buyerlens.session import checkpointed

ID = "customer_unique_id"

# The default grid and the short one.
SEARCH = {
    "kmeans": {"n_clusters": [4, 5, 6]},
    "minibatch_kmeans": {"n_clusters": [4, 5, 6], "batch_size": [1024]},
    "gaussian_mixture": {"n_clusters": [4, 5, 6], "covariance_type": ["diag"]},
}
SEARCH_QUICK = {"kmeans": {"n_clusters": [3, 4]}}
DEFAULT_CLUSTERS = 5
STABILITY = {"n_subsamples": 2, "fraction": 0.80}

TRIAL_SCHEMA = (
    "trial_index int, algorithm string, n_clusters int, params map<string,string>, run_name string, "
    "silhouette double, davies_bouldin double, inertia double, bic double, aic double, "
    "min_size bigint, max_size bigint, min_share double, "
    "stability_ari_subsample double, stability_ari_subsample_std double"
)
PROFILE_SCHEMA = (
    "trial_index int, segment_id int, size bigint, share double, recency_days_mean double, frequency_mean double, "
    "monetary_mean double, avg_ticket_mean double, z_recency_inverted double, z_frequency double, z_monetary double"
)


def search_space(search: dict[str, dict[str, list]]) -> Iterator[dict]:
    """The grid points in order: ``algorithm, n_clusters, params, run_name``."""
    for algorithm, grid in search.items():
        known_algorithm(algorithm)
        axes = {axis: values if isinstance(values, list) else [values] for axis, values in grid.items()}
        sizes = axes.pop("n_clusters", None) or axes.pop("n_components", [DEFAULT_CLUSTERS])
        for k, *rest in itertools.product(sizes, *axes.values()):
            params = dict(zip(axes, rest))
            suffix = "".join(f"_{axis}={value}" for axis, value in params.items())
            yield {"algorithm": algorithm, "n_clusters": int(k), "params": params, "run_name": f"{algorithm}_k{k}{suffix}"}


@dataclass(frozen=True)
class Experiment:
    trials: DataFrame
    winner: Row
    model: SegmentModel
    profiles: DataFrame
    period: Row | None = None
    trial_profiles: DataFrame | None = None


def evaluate_model(model: SegmentModel, features: DataFrame) -> tuple[DataFrame, dict]:
    """Features with their segment, and the metrics of that labelling."""
    labelled = model.clusters.assign(model.prepare(features))
    metrics = cluster_metrics(labelled, "segment_id", model.preprocessor.outputs, with_inertia=False)
    metrics |= {"bic": None, "aic": None, "inertia": None}
    if isinstance(model.clusters, MixtureModel):
        metrics["bic"], metrics["aic"] = model.clusters.information_criteria(*model.clusters.likelihood_of(labelled))
    else:
        metrics["inertia"] = model.clusters.with_distance(labelled).agg(F.sum("d2")).first()[0]
    return labelled.drop(*model.preprocessor.outputs), metrics


@dataclass(frozen=True)
class Search:
    """All trials of a search, their models in grid order, and the labelled profiles of their segments."""

    trials: DataFrame
    models: list[SegmentModel]
    profiles: DataFrame


def search_clusters(features: DataFrame, search: dict = SEARCH, stability: dict = STABILITY, seed: int = 42,
                    centres: list[list[float]] | None = None, rounds: int | None = None) -> Search:
    """Fit and measure every grid point, on all rows and on the subsamples, in shared passes.

    With ``centres`` all models start at the first of these instead of at seeded starts, and with ``rounds``
    they take exactly so many. The driver holds a row per grid point and segment; the observed number of
    clusters replaces the requested one."""
    specs = list(search_space(search))
    matrix = together.prepared(features, ID, seed=seed, **stability)
    members = together.given_starts(matrix, specs, centres) if centres else together.starts(matrix, specs, seed)
    models = together.best_models(matrix, together.fit_all(matrix, members, rounds))
    rows, segments = [], []
    for index, (spec, metrics) in enumerate(zip(specs, together.measure_all(matrix, models))):
        rows.append({**spec, "trial_index": index, "params": {k: str(v) for k, v in spec["params"].items()}, **metrics})
        segments += [{"trial_index": index, **segment} for segment in metrics["segments"]]
    spark = features.sparkSession
    names, profile_names = T.StructType.fromDDL(TRIAL_SCHEMA).names, T.StructType.fromDDL(PROFILE_SCHEMA).names
    return Search(
        spark.createDataFrame([tuple(r[n] for n in names) for r in rows], TRIAL_SCHEMA),
        [SegmentModel(matrix.views[0], models[i, 0], spec=spec) for i, spec in enumerate(specs)],
        label_segments(spark.createDataFrame([tuple(s[n] for n in profile_names) for s in segments], PROFILE_SCHEMA), ["trial_index"]),
    )


def cluster_search(features: DataFrame, search: dict = SEARCH, stability: dict = STABILITY,
                   seed: int = 42) -> DataFrame:
    """The trials of a search: one row per grid point with metrics and stability."""
    return search_clusters(features, search, stability, seed).trials


def fit_spec(features: DataFrame, spec: dict, seed: int = 42) -> SegmentModel:
    """One grid point on these features, with its own preparation."""
    matrix = together.prepared(features, ID, seed=seed, columns=spec.get("columns"))
    members = together.fit_all(matrix, together.starts(matrix, [spec], seed))
    return SegmentModel(matrix.views[0], together.best_models(matrix, members)[0, 0], spec=spec)


def run_experiment(features: DataFrame, search: dict = SEARCH, gates: TrialGates = TrialGates(),
                   stability: dict = STABILITY, other_period: DataFrame | None = None, seed: int = 42,
                   features_uri: str = "", parent_id: str = "") -> Experiment:
    """Search, select, and compare the winner, which was fitted on all rows, with that of another period."""
    base = checkpointed(features)
    found = search_clusters(base, search, stability, seed)
    first = base.select("feature_set_version", "as_of_date").first()
    winner = select_candidate(
        found.trials.withColumn("experiment", F.lit(1)), ["experiment"], gates
    ).drop("experiment").first()
    model = found.models[winner["trial_index"]]
    profiles = found.profiles.where(F.col("trial_index") == winner["trial_index"]).drop("trial_index").orderBy("segment_id")
    labels = {r["segment_id"]: r["segment_label"] for r in profiles.collect()}
    period = None
    if other_period is not None:
        # each model labels its own period
        theirs = fit_spec(other_period, model.spec, seed).assign(other_period)
        period = period_stability(model.assign(base), theirs, ID).first()
    logged = with_lineage(found.trials, first["feature_set_version"], first["as_of_date"], features_uri, parent_id)
    return Experiment(logged, winner, replace(model, labels=labels), profiles, period, found.profiles)


UNMEASURED = {"silhouette": None, "davies_bouldin": None, "n_clusters": 0, "min_size": 0, "min_share": 0.0, "stability_ari_subsample": None}


def run_quality_gates(features: DataFrame, model: SegmentModel, probe_path: str,
                      champions: DataFrame | None = None, policy: PromotionPolicy = PromotionPolicy(),
                      metrics: dict | None = None, seed: int = 42) -> DataFrame:
    """One evaluated candidate row: data, metrics, clusters, signature, write-read probe and smoke.

    ``champions`` is a one-row table with the metrics of the model in production."""
    base = checkpointed(features)
    report = quality.validate_features(base)
    data_ok = quality.report_passed(report).first()[0]
    signature = signature_compatible(model, base)
    if signature["predict_error"]:
        # a model that refuses the features has no clusters to measure
        facts = UNMEASURED | (metrics or {})
    else:
        labelled, computed = evaluate_model(model, base)
        facts = {**computed, **(metrics or {})}
        if facts.get("stability_ari_subsample") is None:
            # the candidate's own algorithm, columns and parameters
            facts |= subsample_stability(
                lambda df: fit_spec(df, model.refit_spec, seed), base, labelled, ID, n_subsamples=1, seed=seed)
    smoke = smoke_predict(model, base, policy.smoke_min_rows)
    probe = integration_probe(base, model, probe_path)
    row = (
        model.name, model.version, data_ok, f"rows={base.count()}", facts["silhouette"], facts["davies_bouldin"],
        facts["n_clusters"], facts["min_size"], facts["min_share"], facts["stability_ari_subsample"],
        signature["passed"], "ok" if signature["passed"] else signature["predict_error"] or str(signature),
        probe["passed"], probe["detail"], smoke["passed"], smoke["detail"],
    )
    candidate = features.sparkSession.createDataFrame([row], (
        "model_name string, model_version string, data_ok boolean, data_detail string, silhouette double, "
        "davies_bouldin double, n_clusters bigint, min_size bigint, min_share double, "
        "stability_ari_subsample double, signature_ok boolean, signature_detail string, "
        "integration_ok boolean, integration_detail string, smoke_ok boolean, smoke_detail string"
    ))
    return evaluate_promotion(with_champion(candidate, champions, ["model_name"]), policy)
