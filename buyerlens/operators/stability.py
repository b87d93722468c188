"""Stability of a clustering over subsamples and between periods."""

from __future__ import annotations

from collections.abc import Callable
from statistics import fmean, pstdev

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.operators.cluster_metrics import adjusted_rand
from buyerlens.operators.ranking import sample_fraction

MIN_OVERLAP = 50


def subsample_stability(fit: Callable[[DataFrame], object], features: DataFrame, labelled: DataFrame,
                        id_column: str, n_subsamples: int = 3, fraction: float = 0.8,
                        seed: int = 42) -> dict:
    """Refit on subsamples and compare with the full labels by ARI on all rows.

    ``fit`` includes the preparation; ``labelled`` holds the features and the
    full model's ``segment_id``."""
    scores = []
    for i in range(n_subsamples):
        model = fit(sample_fraction(features, id_column, fraction, seed + i))
        both = model.assign(labelled, "_again")
        scores.append(adjusted_rand(both, "segment_id", "_again").first()[0])
    return {
        "stability_ari_subsample": fmean(scores) if scores else None,
        "stability_ari_subsample_std": pstdev(scores) if scores else None,
        "stability_n_subsamples": len(scores),
    }


def common_customers(a: DataFrame, b: DataFrame, id_column: str, label: str = "segment_id") -> DataFrame:
    """``label_a, label_b`` of the ids present in both, one row per id."""
    def once(df: DataFrame, out: str) -> DataFrame:
        return df.groupBy(F.col(id_column).cast("string").alias("id")).agg(F.min(label).alias(out))
    return once(a, "label_a").join(once(b, "label_b"), "id")


def period_stability(a: DataFrame, b: DataFrame, id_column: str, label: str = "segment_id",
                     min_overlap: int = MIN_OVERLAP) -> DataFrame:
    """One row: ARI of two labelled periods on common ids, null below ``min_overlap``."""
    common = common_customers(a, b, id_column, label)
    ari = adjusted_rand(common, "label_a", "label_b")
    overlap = common.agg(F.count(F.lit(1)).alias("n"))
    parts = ari.select(F.col("adjusted_rand").alias("v"), F.lit(None).cast("bigint").alias("n")).unionByName(
        overlap.select(F.lit(None).cast("double").alias("v"), "n")
    )
    return parts.agg(F.max("v").alias("v"), F.max("n").alias("n")).select(
        F.when(F.col("n") >= min_overlap, F.col("v")).alias("stability_ari_period"),
        F.col("n").cast("double").alias("stability_period_overlap"),
    )
