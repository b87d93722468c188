"""Quality of a labelling: sizes, inertia, Davies-Bouldin, silhouette, ARI."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buyerlens.operators.ranking import first_by_hash
from buyerlens.operators.sizing import broadcast_if_small
from buyerlens.session import checkpointed

# numbers in a centroid table that is still broadcast
CENTROID_VALUES = 200_000

# centroids of a tile, and pairs of centroids that are compared at a time
TILE = 2_048
PAIRS = 1 << 20

# Size and seed of the silhouette sample.
SILHOUETTE_ROWS = 4000
SILHOUETTE_SEED = 42


def squared_distance(columns: list[str], centre: list) -> Column:
    """Sum of squared differences as one scalar expression; ``centre`` holds numbers or columns."""
    terms = [
        (F.col(c) - (F.lit(float(m)) if isinstance(m, (int, float)) else m)) for c, m in zip(columns, centre)
    ]
    total = terms[0] * terms[0]
    for term in terms[1:]:
        total = total + term * term
    return total


def cluster_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows ``label, size, share``."""
    sizes = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("size"))
    # one row per cluster here
    everything = Window.partitionBy(F.lit(1))
    return sizes.withColumn("share", F.col("size") / F.sum("size").over(everything))


def distribution_summary(df: DataFrame, label: str) -> DataFrame:
    """One row ``n_clusters, min_size, max_size, min_share``; zeros for an empty table."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("size"))
    return sizes.agg(
        F.count(F.lit(1)).alias("n_clusters"),
        F.coalesce(F.min("size"), F.lit(0)).alias("min_size"),
        F.coalesce(F.max("size"), F.lit(0)).alias("max_size"),
        F.coalesce(F.min("size") / F.sum("size"), F.lit(0.0)).alias("min_share"),
    )


def centroids(df: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """One row per label with its size and means ``m_<column>``."""
    return df.groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("size"), *[F.avg(c).alias(f"m_{c}") for c in columns]
    )


def with_own_centroid(df: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """Rows with squared distance ``d2`` to the centroid of their own label.

    The centroids, a row per label, are broadcast while they hold at most
    ``CENTROID_VALUES`` numbers; beyond, it is a shuffled join that splits a hot
    label."""
    centres = broadcast_if_small(
        centroids(df, label, columns).withColumnRenamed("label", "_label"), CENTROID_VALUES // (len(columns) + 2)
    )
    joined = df.join(centres, F.col(label) == F.col("_label"))
    return joined.select(
        F.col(label).alias("label"), "size", *[f"m_{c}" for c in columns],
        squared_distance(columns, [F.col(f"m_{c}") for c in columns]).alias("d2"),
    )


def inertia(df: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """One row: sum of squared distances to the own centroid."""
    return with_own_centroid(df, label, columns).agg(F.sum("d2").alias("inertia"))


def _tiles(centres: pd.DataFrame, columns: list[str]) -> np.ndarray:
    return centres[[f"m_{c}" for c in columns]].to_numpy("float64")


def worst_ratios(columns: list[str]):
    """Of one pair of tiles of centroids: for each in the first, its greatest (S_i + S_j) / M_ij with one of the second."""
    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"label": [], "w": []})
        mine, theirs = _tiles(left, columns), _tiles(right, columns)
        spread, reach = left["s"].to_numpy("float64"), right["s"].to_numpy("float64")
        worst = np.full(len(left), -np.inf)
        for low in range(0, len(right), PAIRS // max(1, len(left)) + 1):
            high = low + PAIRS // max(1, len(left)) + 1
            gap = np.zeros((len(left), len(theirs[low:high])))
            for j in range(len(columns)):
                gap += (mine[:, j][:, None] - theirs[low:high, j][None, :]) ** 2
            gap = np.sqrt(gap)
            # coinciding centroids separate nothing: as in the usual definition they count 0
            ratio = np.divide(spread[:, None] + reach[None, low:high], gap, out=np.zeros_like(gap), where=gap > 0)
            ratio[left["label"].to_numpy()[:, None] == right["label"].to_numpy()[None, low:high]] = -np.inf
            worst = np.maximum(worst, ratio.max(axis=1))
        return pd.DataFrame({"label": left["label"], "w": worst})
    return run


def davies_bouldin(df: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """One row: mean over clusters of the worst (S_i + S_j) / M_ij; null below two clusters.

    Every centroid has to meet every other one, which is the measure's own work. They are dealt into tiles of about ``TILE`` by the
    hash of their label, and a task takes one pair of tiles, so that none holds more than two of them; each tile is sent
    once to each other one. The running maximum is taken within a pair of tiles, then over them."""
    spread = with_own_centroid(df.withColumn(label, F.col(label).cast("string")), label, columns).where("label IS NOT NULL").groupBy("label").agg(
        F.avg(F.sqrt("d2")).alias("s"), *[F.first(f"m_{c}").alias(f"m_{c}") for c in columns])
    spread = checkpointed(spread)
    tiles = max(1, -(-spread.count() // TILE))
    every = F.sequence(F.lit(0), F.lit(tiles - 1))
    dealt = spread.withColumn("t", F.pmod(F.xxhash64("label"), F.lit(tiles)).cast("int"))
    left = dealt.select(F.col("t").alias("a"), F.explode(every).alias("b"), "label", "s", *[f"m_{c}" for c in columns])
    right = dealt.select(F.explode(every).alias("c"), F.col("t").alias("d"), "label", "s", *[f"m_{c}" for c in columns])
    pairs = left.groupBy("a", "b").cogroup(right.groupBy("c", "d")).applyInPandas(worst_ratios(columns), "label string, w double")
    worst = pairs.groupBy("label").agg(F.max("w").alias("w"))
    return worst.agg(F.when(F.count("w") >= 2, F.avg("w")).alias("davies_bouldin"))


def bounded_sample(df: DataFrame, id_column: str, rows: int = SILHOUETTE_ROWS,
                   seed: int = SILHOUETTE_SEED) -> DataFrame:
    """At most ``rows`` rows, the first in a seeded hash order of the id."""
    return first_by_hash(df, id_column, rows, seed)


def squared_silhouette(df: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """One row: mean silhouette of all labelled rows by squared Euclidean distance.

    A row's mean squared distance to a cluster is its squared distance to the centroid plus the
    cluster's variance, so two passes over the rows suffice. The driver holds one row per label, up to
    ``CENTROID_VALUES`` numbers; more labels are an error. Null unless there are at least two clusters
    and fewer clusters than rows. A row alone in its cluster counts 0."""
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("label"), *columns)
    most = CENTROID_VALUES // (len(columns) + 2)
    variance = sum((F.var_pop(c) for c in columns[1:]), F.var_pop(columns[0]))
    summary = distribution_summary(rows, "label").select("n_clusters", (F.col("max_size") > 1).alias("shared")).first()
    if summary.n_clusters < 2 or not summary.shared:
        return df.sparkSession.createDataFrame([(None,)], "silhouette double")
    if summary.n_clusters > most:
        raise ValueError(f"{summary.n_clusters} labels; the silhouette takes up to {most}")
    table = rows.groupBy("label").agg(
        F.count(F.lit(1)).alias("size"), variance.alias("v"), *[F.avg(c).alias(f"m_{c}") for c in columns]
    ).orderBy("label").toPandas()
    code = {name: i for i, name in enumerate(table["label"])}
    centres, spread = table[[f"m_{c}" for c in columns]].to_numpy("float64"), table["v"].to_numpy("float64")
    sizes = table["size"].to_numpy("float64")

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = 0.0, 0
        for batch in batches:
            points, own = batch[columns].to_numpy("float64"), batch["label"].map(code).to_numpy("int64")
            inside, near = np.zeros(len(points)), np.full(len(points), np.inf)
            for k in range(len(sizes)):
                mean = ((points - centres[k]) ** 2).sum(axis=1) + spread[k]
                mine = own == k
                inside[mine] = mean[mine] * sizes[k] / max(1.0, sizes[k] - 1)
                near[~mine] = np.minimum(near[~mine], mean[~mine])
            top = np.maximum(near, inside)
            value = np.divide(near - inside, top, out=np.zeros(len(top)), where=top > 0)
            total, n = total + float(value[sizes[own] > 1].sum()), n + len(points)
        yield pd.DataFrame({"s": [total], "n": [n]})

    return rows.mapInPandas(score, "s double, n long").agg((F.sum("s") / F.sum("n")).alias("silhouette"))


def silhouette(df: DataFrame, label: str, columns: list[str], id_column: str,
               rows: int = SILHOUETTE_ROWS, seed: int = SILHOUETTE_SEED) -> DataFrame:
    """One row: mean Euclidean silhouette of a sample of at most ``rows`` rows.

    The measure is defined on the sample, whose size does not grow with the data.
    Every task scores its share of the sample against the whole sample. Null
    unless there are at least two clusters and fewer clusters than rows."""
    sample = (
        bounded_sample(df.select(id_column, label, *columns), id_column, rows, seed)
        .select(F.col(label).cast("string").alias("label"), *columns).toPandas()
    )
    codes, names = pd.factorize(sample["label"], sort=True)
    spark = df.sparkSession
    if len(names) < 2 or len(names) >= len(sample):
        return spark.createDataFrame([(None,)], "silhouette double")
    points = spark.sparkContext.broadcast(
        (sample[columns].to_numpy("float64"), codes, np.bincount(codes, minlength=len(names)))
    )

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        all_points, all_codes, sizes = points.value
        members = [np.flatnonzero(all_codes == k) for k in range(len(sizes))]
        for batch in batches:
            rows_here = batch["i"].to_numpy()
            d2 = np.zeros((len(rows_here), len(all_points)))
            for j in range(all_points.shape[1]):
                d2 += (all_points[rows_here, j][:, None] - all_points[:, j][None, :]) ** 2
            distance = np.sqrt(d2)
            sums = np.stack([distance[:, m].sum(axis=1) for m in members], axis=1)
            own = all_codes[rows_here]
            at = np.arange(len(rows_here))
            with np.errstate(invalid="ignore", divide="ignore"):
                inside = sums[at, own] / (sizes[own] - 1)
                means = sums / sizes
                means[at, own] = np.inf
                near = means.min(axis=1)
                value = (near - inside) / np.maximum(near, inside)
            # a row alone in its cluster counts 0, as does one at distance 0 from everything
            yield pd.DataFrame({"s": np.where(sizes[own] == 1, 0.0, np.nan_to_num(value))})

    tasks = max(1, min(spark.sparkContext.defaultParallelism, len(sample) // 250 + 1))
    return (
        spark.range(0, len(sample), 1, tasks).withColumnRenamed("id", "i")
        .mapInPandas(score, "s double").agg(F.avg("s").alias("silhouette"))
    )


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts ``a, b, n`` of the label pairs."""
    return df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("n"))


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row ``adjusted_rand``: chance-corrected agreement of two labellings.

    Pairs are counted in doubles: their number exceeds 64 bits long before the
    table does. Two labellings without any pair to tell apart agree fully."""
    counts = contingency(df, a, b)

    def pairs(n: Column) -> Column:
        n = n.cast("double")
        return n * (n - 1) / 2

    cells = counts.agg(F.sum(pairs(F.col("n"))).alias("v"), F.sum("n").alias("n"))
    rows = counts.groupBy("a").agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n"))).alias("v"))
    columns = counts.groupBy("b").agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n"))).alias("v"))
    parts = (
        cells.select(F.lit("cells").alias("part"), "v", "n")
        .unionByName(rows.select(F.lit("rows").alias("part"), "v", F.lit(None).cast("bigint").alias("n")))
        .unionByName(columns.select(F.lit("columns").alias("part"), "v", F.lit(None).cast("bigint").alias("n")))
    )
    sums = parts.agg(
        F.max(F.when(F.col("part") == "cells", F.col("v"))).alias("cells"),
        F.max(F.when(F.col("part") == "rows", F.col("v"))).alias("rows"),
        F.max(F.when(F.col("part") == "columns", F.col("v"))).alias("columns"),
        pairs(F.max("n")).alias("total"),
    )
    expected = F.try_divide(F.col("rows") * F.col("columns"), F.col("total"))
    best = (F.col("rows") + F.col("columns")) / 2
    return sums.select(
        F.when((F.col("total") == 0) | (best == expected), F.lit(1.0))
        .otherwise(F.try_divide(F.col("cells") - expected, best - expected)).alias("adjusted_rand")
    )


def cluster_metrics(df: DataFrame, label: str, columns: list[str], with_inertia: bool = True) -> dict:
    """Silhouette of all rows, Davies-Bouldin, inertia and sizes of one labelling as plain values."""
    sizes = distribution_summary(df, label).first()
    n = df.count()
    metrics: dict = {"silhouette": None, "davies_bouldin": None, "inertia": None, **sizes.asDict()}
    if 2 <= metrics["n_clusters"] < n:
        metrics["silhouette"] = squared_silhouette(df, label, columns).first()[0]
        metrics["davies_bouldin"] = davies_bouldin(df, label, columns).first()[0]
    if with_inertia:
        metrics["inertia"] = inertia(df, label, columns).first()[0]
    return metrics
