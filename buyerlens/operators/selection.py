"""Trial gates, scores and selection as columns over a table of trials."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buyerlens.functions.scalars import SCORE_WEIGHTS, composite_score, finite_or, is_finite


@dataclass(frozen=True)
class TrialGates:
    """The default thresholds."""

    silhouette_min: float = 0.20
    segment_count_between: tuple[int, int] = (3, 10)
    min_cluster_size: int = 20
    min_cluster_share: float = 0.002
    ari_subsample_min: float = 0.50
    weights: dict = field(default_factory=lambda: dict(SCORE_WEIGHTS))


def _gate_columns(gates: TrialGates) -> dict[str, Column]:
    low, high = gates.segment_count_between
    return {
        "silhouette_min": finite_or(F.col("silhouette"), -1) >= gates.silhouette_min,
        "segment_count_between": F.coalesce(F.col("n_clusters"), F.lit(0)).between(low, high),
        "no_empty_segment": F.coalesce(F.col("min_size"), F.lit(0)) >= gates.min_cluster_size,
        "min_cluster_share": finite_or(F.col("min_share"), 0) >= gates.min_cluster_share,
        "ari_subsample_min": finite_or(F.col("stability_ari_subsample"), -1) >= gates.ari_subsample_min,
    }


def with_gates(trials: DataFrame, gates: TrialGates = TrialGates()) -> DataFrame:
    """Add ``gates_passed``: whether a trial meets all five thresholds."""
    passed = F.lit(True)
    for column in _gate_columns(gates).values():
        passed = passed & column
    return trials.withColumn("gates_passed", passed)


def trial_checks(trials: DataFrame, keys: list[str], gates: TrialGates = TrialGates()) -> DataFrame:
    """One row per trial and gate: ``check, passed, value``."""
    measured = {
        "silhouette_min": "silhouette", "segment_count_between": "n_clusters",
        "no_empty_segment": "min_size", "min_cluster_share": "min_share",
        "ari_subsample_min": "stability_ari_subsample",
    }
    rows = F.array(*[
        F.struct(F.lit(name).alias("check"), column.alias("passed"),
                 F.col(measured[name]).cast("double").alias("value"))
        for name, column in _gate_columns(gates).items()
    ])
    return trials.select(*keys, F.explode(rows).alias("g")).select(*keys, "g.*")


def score_trials(trials: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    return trials.withColumn("composite_score", composite_score(
        F.col("silhouette"), F.col("davies_bouldin"), F.col("stability_ari_subsample"), weights
    ))


def select_candidate(trials: DataFrame, by: list[str], gates: TrialGates = TrialGates()) -> DataFrame:
    """Best trial per experiment among those that pass; among all when none does.

    Passing sorts before the score and the earlier trial wins a tie, so the pool
    needs no pass of its own."""
    scored = score_trials(with_gates(trials, gates), gates.weights)
    rest = [c for c in scored.columns if c not in by]
    order = F.struct("gates_passed", "composite_score", -F.col("trial_index"))
    return scored.groupBy(*by).agg(
        F.max_by(F.struct(*rest), order).alias("w"),
        F.count_if("gates_passed").alias("n_passing_gates"),
    ).select(
        *by, "w.*", "n_passing_gates",
        F.when(F.col("n_passing_gates") > 0, "gates_passed").otherwise("best_effort").alias("selection_pool"),
    )


def comparison_table(trials: DataFrame, by: list[str]) -> DataFrame:
    """Metrics of every trial in grid order."""
    return score_trials(with_gates(trials)).select(
        *by, "trial_index", "algorithm", "n_clusters", "silhouette", "davies_bouldin", "inertia",
        "stability_ari_subsample", "composite_score", "gates_passed",
    ).orderBy(*by, "trial_index")


def finite_metrics(trials: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Rows ``metric, value`` of the finite numbers of a trial."""
    rows = F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
    ])
    return trials.select(*keys, F.explode(rows).alias("m")).select(*keys, "m.*").where(is_finite(F.col("value")))


def with_lineage(df: DataFrame, feature_set_version: str, as_of_date: str, features_uri: str,
                 parent_id: str) -> DataFrame:
    """Attach where the rows come from."""
    return df.withColumns({
        "feature_set_version": F.lit(feature_set_version), "as_of_date": F.lit(as_of_date),
        "features_uri": F.lit(features_uri), "parent_run_id": F.lit(parent_id),
    })
