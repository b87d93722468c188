from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from buyerlens.operators import gates, selection

TRIALS = (
    "experiment int, trial_index int, algorithm string, n_clusters int, silhouette double, davies_bouldin double, "
    "stability_ari_subsample double, min_size bigint, min_share double"
)


def test_published_scores(spark):
    """Nine published trials: silhouette, Davies-Bouldin, ARI and their score."""
    rows = [
        (0.345, 0.960, 0.937, 0.585), (0.353, 0.844, 0.664, 0.500), (0.375, 0.791, 0.984, 0.625),
        (0.324, 0.992, 0.616, 0.462), (0.354, 1.063, 0.606, 0.468), (0.311, 0.901, 0.532, 0.431),
        (0.289, 1.202, 0.657, 0.451), (0.338, 1.131, 0.612, 0.460), (0.289, 1.113, 0.726, 0.479),
    ]
    trials = spark.createDataFrame(
        [(1, i, "a", 4 + i % 3, s, d, a, 392, 0.0054) for i, (s, d, a, _) in enumerate(rows)], TRIALS)
    for got, want in zip(selection.score_trials(trials).orderBy("trial_index").collect(), rows):
        assert got.composite_score == pytest.approx(want[3], abs=1.1e-3)
    winner = selection.select_candidate(trials, ["experiment"]).first()
    assert (winner.trial_index, winner.n_passing_gates, winner.selection_pool) == (2, 9, "gates_passed")


def test_passing_beats_a_higher_score(spark):
    rows = [
        (1, 0, "weak", 4, 0.10, 1.5, 0.9, 50, 0.1), (1, 1, "strong", 4, 0.35, 0.8, 0.7, 50, 0.1),
        (2, 0, "a", 4, 0.10, 1.5, 0.9, 50, 0.1), (2, 1, "b", 4, 0.15, 1.5, 0.9, 50, 0.1),
        (3, 0, "first", 4, 0.35, 0.8, 0.7, 50, 0.1), (3, 1, "second", 4, 0.35, 0.8, 0.7, 50, 0.1),
    ]
    trials = spark.createDataFrame(rows, TRIALS)
    scores = [r.composite_score for r in selection.score_trials(trials).orderBy("experiment", "trial_index").collect()]
    assert [round(s, 4) for s in scores[:2]] == [0.44, 0.5136]
    won = {r.experiment: r for r in selection.select_candidate(trials, ["experiment"]).collect()}
    assert (won[1].algorithm, won[1].n_passing_gates) == ("strong", 1)
    assert (won[2].algorithm, won[2].selection_pool) == ("b", "best_effort")
    assert won[3].algorithm == "first"


def test_missing_and_infinite_metrics(spark):
    nan, inf = float("nan"), float("inf")
    trials = spark.createDataFrame([(1, 0, "a", 4, nan, None, inf, 50, 0.1)], TRIALS)
    row = selection.score_trials(selection.with_gates(trials)).first()
    assert row.composite_score == pytest.approx(0.1) and not row.gates_passed
    checks = {r["check"]: r.passed for r in selection.trial_checks(trials, ["trial_index"]).collect()}
    assert checks == {"silhouette_min": False, "segment_count_between": True, "no_empty_segment": True,
                      "min_cluster_share": True, "ari_subsample_min": False}
    assert selection.finite_metrics(trials, ["trial_index"], ["silhouette", "min_share"]).count() == 1


CANDIDATE = (
    "model string, data_ok boolean, data_detail string, silhouette double, davies_bouldin double, n_clusters int, "
    "min_size bigint, min_share double, stability_ari_subsample double, signature_ok boolean, "
    "integration_ok boolean, smoke_ok boolean"
)


def decide(spark, champion=(0.33, 0.85), policy=gates.PromotionPolicy(), **changes):
    base = dict(model="m", data_ok=True, data_detail="rows=90", silhouette=0.35, davies_bouldin=0.8, n_clusters=3,
                min_size=30, min_share=1 / 3, stability_ari_subsample=0.8, signature_ok=True, integration_ok=True,
                smoke_ok=True) | changes
    candidate = spark.createDataFrame([tuple(base.values())], CANDIDATE)
    champions = champion and spark.createDataFrame([("m", *champion)], "model string, silhouette double, davies_bouldin double")
    return gates.evaluate_promotion(gates.with_champion(candidate, champions, ["model"]), policy)


def failed(evaluated):
    return evaluated.first().blocking_failed


def test_approved(spark):
    row = decide(spark).first()
    assert row.decision == "approved" and row.approved and row.blocking_failed == []
    assert len(row.checks) == 6


def test_regression(spark):
    assert failed(decide(spark, (0.40, 0.70), silhouette=0.22, davies_bouldin=1.5)) == ["metric_regression"]
    assert failed(decide(spark, (0.35, 0.30))) == ["metric_regression"]
    assert failed(decide(spark, None, silhouette=0.22)) == []
    assert failed(decide(spark, None, silhouette=None)) == ["metric_regression"]
    # a champion without metrics is compared with the candidate's own
    assert failed(decide(spark, (None, None))) == []
    detail = {c.name: c.detail for c in decide(spark, None).first().checks}["metric_regression"]
    assert detail == "sem champion prévio; silhouette=0.350 (min 0.2)"


def test_clusters(spark):
    bad = decide(spark, n_clusters=2, min_size=1, min_share=1 / 90, stability_ari_subsample=0.1)
    assert failed(bad) == ["unstable_or_empty_clusters"]
    assert failed(decide(spark, stability_ari_subsample=None)) == ["unstable_or_empty_clusters"]


def test_data_signature_and_integration(spark):
    assert failed(decide(spark, data_ok=False)) == ["data_failure"]
    assert failed(decide(spark, signature_ok=False, integration_ok=False)) == [
        "signature_incompatible", "integration_failure"]


def test_smoke_folds_into_integration(spark):
    row = decide(spark, smoke_ok=False).first()
    assert row.blocking_failed == ["integration_failure"] and row.decision == "rejected"
    checks = {c.name: c for c in row.checks}
    assert checks["integration_failure"].detail == "integração ok; smoke falhou"
    listed = gates.PromotionPolicy(blocking=("integration_failure", "smoke"))
    assert failed(decide(spark, policy=listed, smoke_ok=False)) == ["smoke"]
    assert failed(decide(spark, policy=gates.PromotionPolicy(blocking=("data_failure",)), smoke_ok=False)) == []


def test_tags(spark):
    long = decide(spark, data_detail="x" * 900, signature_ok=False)
    tags = {r.tag: r.value for r in gates.gate_tags(long, ["model"]).collect()}
    assert len(tags) == 15 and tags["quality_gate_decision"] == "rejected"
    assert tags["quality_gate_approved"] == "false"
    assert tags["quality_gate_blocking_failed"] == '["signature_incompatible"]'
    assert tags["quality_gate_data_failure"] == "pass" and len(tags["quality_gate_data_failure_detail"]) == 500
    assert tags["quality_gate_unstable_or_empty_clusters_detail"] == "k=3 min_size=30 min_share=0.3333 ari=0.800"


def test_lineage_and_comparison(spark):
    trials = spark.createDataFrame([(1, 0, "a", 4, 0.3, 0.8, 0.7, 50, 0.1)], TRIALS)
    row = selection.with_lineage(trials, "1.0.0", "2018-08-31", "uri", "p").first()
    assert (row.feature_set_version, row.parent_run_id) == ("1.0.0", "p")
    table = selection.comparison_table(trials.withColumn("inertia", F.lit(1.0)), ["experiment"])
    assert table.first().gates_passed
