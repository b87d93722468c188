"""Promotion gates over a table of candidates: checks, decision and tags."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buyerlens.functions.scalars import finite_or


@dataclass(frozen=True)
class PromotionPolicy:
    """Thresholds, blocking gates and texts of the default policy."""

    silhouette_min: float = 0.20
    silhouette_max_drop: float = 0.05
    davies_bouldin_max_increase: float = 0.40
    ari_subsample_min: float = 0.50
    min_cluster_size: int = 20
    min_cluster_share: float = 0.002
    n_clusters_between: tuple[int, int] = (3, 10)
    smoke_min_rows: int = 5
    blocking: tuple[str, ...] = (
        "data_failure", "metric_regression", "unstable_or_empty_clusters",
        "signature_incompatible", "integration_failure",
    )
    approved: str = "approved"
    rejected: str = "rejected"
    tag_prefix: str = "quality_gate_"


def with_champion(candidates: DataFrame, champions: DataFrame | None, on: list[str]) -> DataFrame:
    """Attach ``champion_silhouette, champion_davies_bouldin, has_champion``.

    ``champions`` holds the metrics of the model in production per ``on``."""
    if champions is None:
        return candidates.withColumns({
            "champion_silhouette": F.lit(None).cast("double"),
            "champion_davies_bouldin": F.lit(None).cast("double"), "has_champion": F.lit(False),
        })
    known = champions.select(
        *on, F.col("silhouette").alias("champion_silhouette"),
        F.col("davies_bouldin").alias("champion_davies_bouldin"), F.lit(True).alias("_known"),
    )
    joined = candidates.join(known, on, "left")
    return joined.withColumn("has_champion", F.coalesce("_known", F.lit(False))).drop("_known")


def _check(name: str, passed: Column, detail: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), passed.alias("passed"), detail.alias("detail"))


def _given(df: DataFrame, flag: str, detail: str, ok: str, failed: str) -> tuple[Column, Column]:
    """A check decided elsewhere: its flag and a detail with a default text."""
    passed = F.coalesce(F.col(flag), F.lit(False)) if flag in df.columns else F.lit(True)
    default = F.when(passed, ok).otherwise(failed)
    text = F.coalesce(F.nullif(F.col(detail), F.lit("")), default) if detail in df.columns else default
    return passed, text


def metric_regression(policy: PromotionPolicy) -> tuple[Column, Column]:
    own = finite_or(F.col("silhouette"), -1)
    absolute = own >= policy.silhouette_min
    champion = F.coalesce(finite_or(F.col("champion_silhouette"), float("nan")), own)
    champion = F.when(F.isnan(champion), own).otherwise(champion)
    drop = champion - own
    spread = finite_or(F.col("davies_bouldin"), 0)
    before = finite_or(F.col("champion_davies_bouldin"), float("nan"))
    increase = spread - F.when(F.isnan(before), spread).otherwise(before)
    compared = absolute & (drop <= policy.silhouette_max_drop) & (increase <= policy.davies_bouldin_max_increase)
    passed = F.when(F.col("has_champion"), compared).otherwise(absolute)
    detail = F.when(
        F.col("has_champion"),
        F.format_string("sil %.3f vs champion %.3f (drop=%.3f); db Δ=%.3f", own, champion, drop, increase),
    ).otherwise(
        F.format_string(f"sem champion prévio; silhouette=%.3f (min {policy.silhouette_min})", own)
    )
    return passed, detail


def cluster_health(policy: PromotionPolicy) -> tuple[Column, Column]:
    low, high = policy.n_clusters_between
    ari = finite_or(F.col("stability_ari_subsample"), -1)
    passed = (
        (F.col("min_size") >= policy.min_cluster_size) & (F.col("min_share") >= policy.min_cluster_share)
        & F.col("n_clusters").between(low, high) & (ari >= policy.ari_subsample_min)
    )
    detail = F.format_string(
        "k=%d min_size=%d min_share=%.4f ari=%.3f", F.col("n_clusters").cast("bigint"),
        F.col("min_size").cast("bigint"), F.col("min_share"), ari,
    )
    return F.coalesce(passed, F.lit(False)), detail


def evaluate_promotion(candidates: DataFrame, policy: PromotionPolicy = PromotionPolicy()) -> DataFrame:
    """Add ``checks, blocking_failed, decision, approved`` to every candidate.

    A failed smoke test fails the integration gate when the policy blocks on
    that gate and does not list the smoke test itself."""
    data = _given(candidates, "data_ok", "data_detail", "feature table válida", "falha de dados/contrato")
    signature = _given(candidates, "signature_ok", "signature_detail", "assinatura ok", "assinatura ok")
    probe = _given(candidates, "integration_ok", "integration_detail", "integração ok", "integração ok")
    smoke = _given(candidates, "smoke_ok", "smoke_detail", "smoke ok", "smoke ok")
    if "integration_failure" in policy.blocking and "smoke" not in policy.blocking:
        folded = ~smoke[0] & probe[0]
        probe = (
            probe[0] & smoke[0],
            F.when(folded, F.concat(probe[1], F.lit("; smoke falhou"))).otherwise(probe[1]),
        )
    checks = F.array(
        _check("data_failure", *data),
        _check("metric_regression", *metric_regression(policy)),
        _check("unstable_or_empty_clusters", *cluster_health(policy)),
        _check("signature_incompatible", *signature),
        _check("integration_failure", *probe),
        _check("smoke", *smoke),
    )
    failed = F.transform(
        F.filter("checks", lambda c: ~c["passed"] & c["name"].isin(list(policy.blocking))), lambda c: c["name"]
    )
    clear = F.size("blocking_failed") == 0
    return (
        candidates.withColumn("checks", checks)
        .withColumn("blocking_failed", failed)
        .withColumn("decision", F.when(clear, policy.approved).otherwise(policy.rejected))
        .withColumn("approved", clear)
    )


def check_rows(evaluated: DataFrame, keys: list[str]) -> DataFrame:
    """One row per candidate and check."""
    return evaluated.select(*keys, F.explode("checks").alias("c")).select(*keys, "c.*")


def gate_tags(evaluated: DataFrame, keys: list[str], policy: PromotionPolicy = PromotionPolicy()) -> DataFrame:
    """Flat ``tag, value`` rows of a decision; details are cut to 500 characters."""
    quoted = F.transform("blocking_failed", lambda n: F.concat(F.lit('"'), n, F.lit('"')))
    head = F.array(
        F.struct(F.lit("decision").alias("tag"), F.col("decision").alias("value")),
        F.struct(F.lit("approved").alias("tag"), F.col("approved").cast("string").alias("value")),
        F.struct(F.lit("blocking_failed").alias("tag"),
                 F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")).alias("value")),
    )
    states = F.transform("checks", lambda c: F.struct(
        c["name"].alias("tag"), F.when(c["passed"], "pass").otherwise("fail").alias("value")))
    details = F.transform("checks", lambda c: F.struct(
        F.concat(c["name"], F.lit("_detail")).alias("tag"),
        F.substring(F.coalesce(c["detail"], F.lit("")), 1, 500).alias("value")))
    return evaluated.select(*keys, F.explode(F.concat(head, states, details)).alias("t")).select(
        *keys, F.concat(F.lit(policy.tag_prefix), "t.tag").alias("tag"), "t.value"
    )
