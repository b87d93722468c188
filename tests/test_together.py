"""Many clusterings in shared passes against the single fits and measures."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from buyerlens.operators import cluster_metrics as metrics
from buyerlens.operators import clustering, profiles, scoring, stability, together
from buyerlens.operators.ranking import in_samples, sample_fraction
from buyerlens.plans import training

ID = training.ID
GRID = {
    "kmeans": {"n_clusters": [2, 3], "n_init": [2]}, "minibatch_kmeans": {"n_clusters": [3], "batch_size": [32]},
    "gaussian_mixture": {"n_clusters": [3], "covariance_type": ["diag"]},
}
STARTS = [[1.5, -1.0, -1.0, -1.0, 0.0, -1.0], [-1.0, 1.0, 1.0, 1.0, 0.0, 1.0], [0.0, 0.1, 0.0, 0.0, 0.3, 0.0]]


@pytest.fixture(scope="module")
def found(toy_features):
    return training.search_clusters(toy_features, GRID, {"n_subsamples": 2, "fraction": 0.8})


def test_trials_agree_with_single_measures(toy_features, found):
    rows = found.trials.orderBy("trial_index").collect()
    assert [r.run_name for r in rows] == [
        "kmeans_k2_n_init=2", "kmeans_k3_n_init=2", "minibatch_kmeans_k3_batch_size=32", "gaussian_mixture_k3_covariance_type=diag"]
    for row, model in zip(rows, found.models):
        labelled, single = training.evaluate_model(model, toy_features)
        for name in ("n_clusters", "min_size", "max_size"):
            assert row[name] == single[name]
        for name in ("silhouette", "davies_bouldin", "inertia", "bic", "aic", "min_share"):
            assert row[name] == (None if single[name] is None else pytest.approx(single[name], rel=1e-9))
        own = {r.segment_id: r for r in profiles.build_profiles(labelled).collect()}
        mine = {r.segment_id: r for r in found.profiles.where(F.col("trial_index") == row.trial_index).collect()}
        assert own.keys() == mine.keys()
        for key, r in own.items():
            assert (mine[key].segment_label, mine[key]["size"], mine[key].description) == (r.segment_label, r["size"], r.description)
            assert mine[key].z_monetary == pytest.approx(r.z_monetary) and mine[key].avg_ticket_mean == pytest.approx(r.avg_ticket_mean)


def test_three_blocks_are_found(found):
    """Three separated blocks of thirty: all algorithms with three clusters find them, whatever the subsample."""
    for row in found.trials.where("trial_index > 0").collect():
        assert (row.n_clusters, row.min_size, row.max_size) == (3, 30, 30)
        assert row.stability_ari_subsample == 1.0 and row.stability_ari_subsample_std == 0.0


def test_given_starts_follow_the_single_fits(toy_features):
    """Lloyd and EM rounds in numpy, from the same starts."""
    matrix = together.prepared(toy_features, ID)
    rows = matrix.rows.select(*matrix.columns(0)).toPandas().to_numpy("float64")
    specs = [{"algorithm": a, "n_clusters": 3, "params": {}} for a in ("kmeans", "gaussian_mixture", "minibatch_kmeans")]
    members = together.fit_all(matrix, together.given_starts(matrix, specs, STARTS), 4)
    models = together.best_models(matrix, members)
    centres = np.array(STARTS)
    for _ in range(4):
        own, _ = clustering._nearest(rows, centres)
        centres = np.stack([rows[own == k].mean(axis=0) if (own == k).any() else centres[k] for k in range(3)])
    assert np.allclose(models[0, 0].centres, centres)
    mixture = clustering._maximise(clustering._hard_sums(rows, np.array(STARTS)), len(rows), 3, 6, together.FLOOR)
    for _ in range(4):
        sums = clustering._responsibility_sums(rows, [mixture])
        mixture = clustering._maximise(sums[:-1], len(rows), 3, 6, together.FLOOR)
    assert np.allclose(models[1, 0].means, mixture[1]) and np.allclose(models[1, 0].variances, mixture[2])
    level = clustering._responsibility_sums(rows, [mixture])[-1]
    assert models[1, 0].log_likelihood == pytest.approx(level)
    ids = matrix.rows.select("_position").toPandas()["_position"].to_numpy()
    assert (np.diff(ids) >= 0).all() or matrix.rows.rdd.getNumPartitions() > 1


def test_passes_do_not_grow_with_the_models(spark, toy_features, monkeypatch):
    """The jobs of a search are those of its slowest model."""
    matrix = together.prepared(toy_features, ID, n_subsamples=2)
    passes = []
    plain = together._pass
    monkeypatch.setattr(together, "_pass", lambda *a: passes.append(1) or plain(*a))
    tracker = spark.sparkContext.statusTracker()

    def run(specs: list[dict]) -> tuple[int, int]:
        spark.sparkContext.setJobGroup("together", "")
        before, jobs = len(passes), len(tracker.getJobIdsForGroup("together"))
        models = together.best_models(matrix, together.fit_all(matrix, together.given_starts(matrix, specs, STARTS), 3))
        together.measure_all(matrix, models)
        return len(passes) - before, len(tracker.getJobIdsForGroup("together")) - jobs

    one = {"algorithm": "gaussian_mixture", "n_clusters": 3, "params": {}}
    few, jobs = run([one])
    every = list(training.search_space({a: {"n_clusters": [1, 2, 3]} for a in ("kmeans", "minibatch_kmeans", "gaussian_mixture")}))
    many, more = run(every)
    assert len(every) == 9 and many == few == 7 and more == jobs


def test_a_hot_group_of_equal_rows(spark, toy_features):
    """Equal rows in their thousands, one cluster for all but a few."""
    copies = toy_features.limit(1).crossJoin(spark.range(3_000)).withColumn(
        "customer_unique_id", F.concat(F.lit("x"), F.col("id").cast("string"))).drop("id")
    found = training.search_clusters(toy_features.unionByName(copies), {"kmeans": {"n_clusters": [3], "n_init": [2]}}, {"n_subsamples": 1, "fraction": 0.5})
    row = found.trials.first()
    assert row.n_clusters == 3 and row.max_size >= 3_000 and sum(r["size"] for r in found.profiles.collect()) == 3_090


def test_sample_predicates_are_the_samples(toy_features):
    for seed, inside in zip((42, 43), in_samples(toy_features, ID, 0.8, [42, 43])):
        ids = {r[0] for r in sample_fraction(toy_features, ID, 0.8, seed).select(ID).collect()}
        assert {r[0] for r in toy_features.where(inside).select(ID).collect()} == ids and len(ids) == 72


def test_rand_index():
    assert together.rand_index(np.array([[3.0, 0], [0, 4]])) == 1.0
    assert together.rand_index(np.array([[5.0]])) == 1.0
    table = np.array([[5, 2, 1], [1, 6, 0]])
    rows = [(a, b) for a in range(2) for b in range(3) for _ in range(table[a, b])]
    same = sum((x[0] == y[0]) == (x[1] == y[1]) for i, x in enumerate(rows) for y in rows[:i])
    # the unadjusted index bounds the adjusted one
    assert together.rand_index(table) < same / (len(rows) * (len(rows) - 1) / 2)


def test_the_gate_refits_the_candidate_s_own_spec(toy_features, found, tmp_path, monkeypatch):
    fitted = []
    plain = training.fit_spec
    monkeypatch.setattr(training, "fit_spec", lambda df, spec, seed=42: fitted.append(spec) or plain(df, spec, seed))
    training.run_quality_gates(toy_features, found.models[2], f"{tmp_path}/probe").first()
    assert fitted[0]["algorithm"] == "minibatch_kmeans" and fitted[0]["params"] == {"batch_size": 32}
    assert scoring.SegmentModel(found.models[1].preprocessor, found.models[1].clusters).refit_spec["algorithm"] == "kmeans"


def test_unknown_parameters_are_errors(toy_features):
    with pytest.raises(ValueError, match="n_jobs"):
        training.search_clusters(toy_features, {"kmeans": {"n_clusters": [2], "n_jobs": [1]}}, {"n_subsamples": 0})


def test_stability_alone_agrees(toy_features, found):
    model = found.models[1]
    labelled = model.assign(toy_features)
    single = stability.subsample_stability(lambda df: training.fit_spec(df, model.refit_spec), toy_features, labelled, ID, n_subsamples=1)
    assert single["stability_ari_subsample"] == 1.0
    assert metrics.distribution_summary(labelled, "segment_id").first().min_size == 30
