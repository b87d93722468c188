from __future__ import annotations

import pytest
from conftest import at
from pyspark.sql import functions as F

from buyerlens.contracts import SEGMENT_COLUMNS
from buyerlens.functions.scalars import SEGMENT_DESCRIPTIONS
from buyerlens.operators import profiles, scoring
from buyerlens.plans import pipelines, training
from buyerlens.sources import partitions


@pytest.fixture(scope="module")
def model(toy_features):
    return scoring.fit_model(toy_features, "kmeans", 3, n_init=2)


@pytest.fixture(scope="module")
def segments(toy_features, model):
    return scoring.assign_segments(toy_features, model, scored_at="2018-09-02 00:00:00").cache()


def test_published_columns(segments):
    assert segments.columns == SEGMENT_COLUMNS and segments.count() == 90
    assert segments.select("customer_unique_id").distinct().count() == 90
    assert {r.segment_label for r in segments.collect()} == {"cluster_0", "cluster_1", "cluster_2"}


def test_labels_and_missing_scores(spark, toy_features, model):
    labels = spark.createDataFrame([(0, "gold")], "segment_id int, segment_label string")
    scored = scoring.assign_segments(toy_features, model, labels)
    names = {(r.segment_id, r.segment_label) for r in scored.collect()}
    assert names == {(0, "gold"), (1, "cluster_1"), (2, "cluster_2")}
    bare = scoring.segment_projection(
        toy_features.select("customer_unique_id", "as_of_date", "recency_days", "frequency", "monetary",
                            F.lit(1).alias("segment_id"), F.lit("x").alias("segment_label")), "m", "1", "1.0.0")
    assert bare.first().r_score is None


def test_invalid_features_are_refused(toy_features, model):
    with pytest.raises(ValueError):
        scoring.assign_segments(toy_features.limit(0), model)
    with pytest.raises(ValueError, match="frequency_positive"):
        scoring.assign_segments(toy_features.withColumn("frequency", F.lit(0)), model)


def test_profiles(toy_features, model):
    rows = profiles.build_profiles(model.assign(toy_features)).collect()
    assert [r.segment_id for r in rows] == [0, 1, 2] and sum(r["size"] for r in rows) == 90
    assert {r.segment_label for r in rows} >= {"champions", "hibernating"}
    assert all(r.description in SEGMENT_DESCRIPTIONS.values() for r in rows)


def test_equal_base_labels_are_numbered(toy_features):
    halves = toy_features.withColumn("segment_id", F.expr("int(substring(customer_unique_id, 2, 3)) % 4"))
    labels = [r.segment_label for r in profiles.build_profiles(halves).collect()]
    assert labels == ["need_attention", "need_attention_2", "need_attention_3", "need_attention_4"]


def test_constant_column_has_z_zero(toy_features):
    flat = toy_features.withColumn("monetary", F.lit(0.1)).withColumn("segment_id", F.col("frequency"))
    assert {r.z_monetary for r in profiles.segment_statistics(flat).collect()} == {0.0}


def test_lookup(spark, segments):
    later = segments.where("customer_unique_id = 'c001'").withColumn("segment_label", F.lit("new")).withColumn(
        "scored_at", F.lit(at("2018-09-05")))
    ids = spark.createDataFrame([("c001",), ("c001",), ("c002",), ("nobody",)], "customer_unique_id string")
    rows = {r.customer_unique_id: r for r in scoring.segment_lookup(ids, segments.unionByName(later)).collect()}
    assert len(rows) == 3 and rows["c001"].segment_label == "new"
    assert rows["nobody"].segment_id is None and rows["c002"].updated_at == "2018-09-02 00:00:00"


def test_health(segments):
    row = scoring.segments_health(segments).first()
    assert (row.status, row.n_customers, row.n_segments) == ("ok", 90, 3)
    empty = scoring.segments_health(segments.limit(0)).first()
    assert empty.status == "degraded" and not empty.scores_available


def test_store_publish_and_read(spark, tmp_path, toy_features, model, segments):
    root = str(tmp_path)
    pipelines.persist_features(toy_features, f"{root}/features", f"{root}/log")
    with pytest.raises(FileNotFoundError):
        pipelines.run_batch_scoring(spark, root, "2018-07-31", model)
    for _ in range(2):
        summary = pipelines.run_batch_scoring(spark, root, "2018-08-31", model)
        assert (summary["row_count"], summary["n_segments"]) == (90, 3)
    assert pipelines.current_segments(spark, root).count() == 90
    later = segments.withColumn("as_of_date", F.lit("2018-09-30")).limit(5)
    scoring.persist_segments(later, f"{root}/segments")
    # the pointer still names August
    assert pipelines.current_segments(spark, root).count() == 90
    scoring.publish_current(spark, f"{root}/segments", "2018-09-30")
    assert pipelines.current_segments(spark, root).count() == 5
    assert spark.read.parquet(f"{root}/log").count() == 3
    history = partitions.dataset_summary(scoring.segment_store(spark, f"{root}/segments").all(), "customer_segments")
    assert sorted(r.row_count for r in history.collect()) == [5, 90]
    assert scoring.write_campaigns(segments, f"{root}/campaigns") == 90


def test_migration(segments):
    moved = segments.where("customer_unique_id >= 'c010'").withColumn("segment_label", F.lit("x"))
    rows = scoring.segment_migration(segments, moved).collect()
    assert sum(r.n for r in rows) == 90 and sum(r.n for r in rows if r.to_label is None) == 10
    drift = {r.segment_label: r.delta for r in scoring.share_drift(segments, moved).collect()}
    assert drift["x"] == 1.0


def test_experiment_and_gates(spark, tmp_path, toy_features):
    search = {"kmeans": {"n_clusters": [3], "n_init": [2]}, "gaussian_mixture": {"n_clusters": [3]}}
    stability = {"n_subsamples": 1, "fraction": 0.8}
    found = training.run_experiment(toy_features, search, stability=stability, other_period=toy_features)
    rows = found.trials.orderBy("trial_index").collect()
    assert [r.run_name for r in rows] == ["kmeans_k3_n_init=2", "gaussian_mixture_k3"]
    assert rows[0].inertia > 0 and rows[0].bic is None and rows[1].bic is not None
    assert found.winner.gates_passed and found.period.stability_ari_period == 1.0
    assert set(found.model.labels) == {0, 1, 2}
    row = training.run_quality_gates(
        toy_features, found.model, f"{tmp_path}/probe", metrics={"stability_ari_subsample": 0.9}).first()
    assert row.decision == "approved" and row.integration_ok
    broken = training.run_quality_gates(
        toy_features.withColumn("frequency", F.lit(0)), found.model, f"{tmp_path}/probe",
        metrics={"stability_ari_subsample": 0.9}).first()
    assert "data_failure" in broken.blocking_failed and "integration_failure" in broken.blocking_failed
