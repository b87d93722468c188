"""Segment profiles: cluster means against the whole base, and their business labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from buyerlens.functions.scalars import label_description, segment_label
from buyerlens.operators.ranking import disambiguate_labels

RFM = ("recency_days", "frequency", "monetary")


def segment_statistics(df: DataFrame, label: str = "segment_id",
                       rfm: tuple[str, str, str] = RFM) -> DataFrame:
    """Size, share, means and z-scores per segment in one aggregation.

    Global mean and population deviation are put together from the per-segment
    moments, so the rows are read once and nothing is joined. The windows span
    one row per segment."""
    moments = []
    for c in rfm:
        value = F.col(c).cast("double")
        moments += [
            F.avg(value).alias(f"{c}_mean"), F.var_pop(value).alias(f"{c}_var"),
            F.min(value).alias(f"{c}_low"), F.max(value).alias(f"{c}_high"),
        ]
    ticket = F.avg("avg_ticket") if "avg_ticket" in df.columns else F.lit(None).cast("double")
    grouped = df.groupBy(F.col(label).cast("int").alias("segment_id")).agg(
        F.count(F.lit(1)).alias("size"), *moments, ticket.alias("avg_ticket_mean")
    )
    base = Window.partitionBy(F.lit(1))
    total = F.sum("size").over(base)
    means = {
        c: F.sum(F.col("size") * F.col(f"{c}_mean")).over(base) / total for c in rfm
    }
    with_means = grouped.select("*", (F.col("size") / total).alias("share"),
                                *[m.alias(f"{c}_all") for c, m in means.items()])
    z = {}
    for c in rfm:
        gap = F.col(f"{c}_mean") - F.col(f"{c}_all")
        variance = F.sum(F.col("size") * (F.col(f"{c}_var") + gap * gap)).over(base) / F.sum("size").over(base)
        constant = F.min(f"{c}_low").over(base) == F.max(f"{c}_high").over(base)
        z[c] = F.when(constant, F.lit(0.0)).otherwise(gap / F.sqrt(variance))
    return with_means.select(
        "segment_id", "size", "share", *[f"{c}_mean" for c in rfm], "avg_ticket_mean",
        (-z[rfm[0]]).alias("z_recency_inverted"), z[rfm[1]].alias("z_frequency"), z[rfm[2]].alias("z_monetary"),
    )


def label_segments(statistics: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Add a business label, unique among the rows that agree in ``by``, and its description."""
    based = statistics.withColumn(
        "base_label", segment_label(F.col("z_recency_inverted"), F.col("z_frequency"), F.col("z_monetary"))
    )
    named = disambiguate_labels(based, "base_label", "segment_id", "segment_label", by)
    return named.withColumn("description", label_description(F.col("base_label"))).drop("base_label")


def build_profiles(df: DataFrame, label: str = "segment_id") -> DataFrame:
    """Labelled profiles in segment order."""
    return label_segments(segment_statistics(df, label)).orderBy("segment_id")


def label_map(profiles: DataFrame) -> DataFrame:
    return profiles.select("segment_id", "segment_label")
