from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from buyerlens.operators import clustering, preprocess
from buyerlens.operators import cluster_metrics as M
from buyerlens.operators import scoring, stability
from buyerlens.plans import training

RNG = np.random.RandomState(5)
CENTRES = np.array([[0.0, 0.0], [8.0, 0.0], [0.0, 9.0]])
LABELS = np.repeat([0, 1, 2], [60, 25, 15])
POINTS = CENTRES[LABELS] + RNG.normal(size=(100, 2)) * [1.0, 0.5]


@pytest.fixture(scope="module")
def blobs(spark):
    rows = [(i, int(LABELS[i]), float(x), float(y)) for i, (x, y) in enumerate(POINTS)]
    return spark.createDataFrame(rows, "id int, label int, x double, y double").repartition(4).cache()


def distances(points):
    return np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))


def plain_silhouette(points, labels):
    d, out = distances(points), []
    for i, own in enumerate(labels):
        same = (labels == own).sum()
        if same == 1:
            out.append(0.0)
            continue
        a = d[i, labels == own].sum() / (same - 1)
        b = min(d[i, labels == k].mean() for k in set(labels) if k != own)
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def plain_davies_bouldin(points, labels):
    ks = sorted(set(labels))
    c = np.array([points[labels == k].mean(axis=0) for k in ks])
    s = [np.linalg.norm(points[labels == k] - c[i], axis=1).mean() for i, k in enumerate(ks)]
    return float(np.mean([
        max((s[i] + s[j]) / np.linalg.norm(c[i] - c[j]) for j in range(len(ks)) if j != i) for i in range(len(ks))
    ]))


def test_metrics_match_plain_numpy(blobs):
    columns = ["x", "y"]
    assert M.silhouette(blobs, "label", columns, "id").first()[0] == pytest.approx(plain_silhouette(POINTS, LABELS))
    assert M.davies_bouldin(blobs, "label", columns).first()[0] == pytest.approx(plain_davies_bouldin(POINTS, LABELS))
    own = np.array([POINTS[LABELS == k].mean(axis=0) for k in range(3)])
    assert M.inertia(blobs, "label", columns).first()[0] == pytest.approx(((POINTS - own[LABELS]) ** 2).sum())
    row = M.distribution_summary(blobs, "label").first()
    assert (row.n_clusters, row.min_size, row.max_size, row.min_share) == (3, 15, 60, 0.15)


def test_centroids_beyond_the_broadcast_bound(blobs, monkeypatch):
    small = M.inertia(blobs, "label", ["x", "y"])
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(M, "CENTROID_VALUES", 8)
    large = M.inertia(blobs, "label", ["x", "y"])
    assert large.first()[0] == pytest.approx(small.first()[0])


def test_silhouette_edges(spark, blobs):
    assert M.silhouette(blobs.withColumn("label", F.lit(0)), "label", ["x", "y"], "id").first()[0] is None
    assert M.silhouette(blobs, "id", ["x", "y"], "id").first()[0] is None
    labels = np.where(np.arange(100) == 7, 9, LABELS)
    alone = blobs.withColumn("label", F.when(F.col("id") == 7, 9).otherwise(F.col("label")))
    assert M.silhouette(alone, "label", ["x", "y"], "id").first()[0] == pytest.approx(plain_silhouette(POINTS, labels))
    assert M.davies_bouldin(blobs.withColumn("label", F.lit(0)), "label", ["x", "y"]).first()[0] is None


def test_squared_silhouette_takes_all_rows(spark, blobs):
    def plain(points, labels):
        d, out = distances(points) ** 2, []
        for i, own in enumerate(labels):
            a = d[i, labels == own].sum() / ((labels == own).sum() - 1)
            b = min(d[i, labels == k].mean() for k in set(labels) if k != own)
            out.append((b - a) / max(a, b))
        return np.mean(out)

    assert M.squared_silhouette(blobs, "label", ["x", "y"]).first()[0] == pytest.approx(plain(POINTS, LABELS))
    assert M.squared_silhouette(blobs.withColumn("label", F.lit(0)), "label", ["x", "y"]).first()[0] is None
    assert M.squared_silhouette(blobs, "id", ["x", "y"]).first()[0] is None
    many = spark.range(6000).select("id", (F.col("id") % 2).alias("label"), (F.col("id") % 2 * 5 + F.col("id") / 6000).alias("x"))
    one = many.withColumn("x", F.when(F.col("id") == 5500, 400.0).otherwise(F.col("x")))
    found = [M.squared_silhouette(df, "label", ["x"]).first()[0] for df in (many, one)]
    assert found[0] - found[1] > 0.01


def test_minibatch_sees_all_rows(spark):
    n = 12_000
    df = spark.range(n).select("id", (F.col("id") % 3 * 10 + F.xxhash64("id") % 100 / 100).alias("x"))
    model = clustering.fit_minibatch_kmeans(df, ["x"], 3, "id", batch_size=64, n_init=2)
    assert np.allclose(sorted(c[0] for c in model.centres), [0, 10, 20], atol=0.2)
    moved = df.withColumn("x", F.when(F.col("id") == n - 1, 1000.0).otherwise(F.col("x")))
    other = clustering.fit_minibatch_kmeans(moved, ["x"], 3, "id", batch_size=64, n_init=2)
    assert not np.allclose(sorted(model.centres), sorted(other.centres), atol=1e-3)


def test_silhouette_sample_is_reproducible(blobs):
    small = M.silhouette(blobs, "label", ["x", "y"], "id", rows=40).first()[0]
    assert small == pytest.approx(M.silhouette(blobs.repartition(9), "label", ["x", "y"], "id", rows=40).first()[0])
    kept = M.bounded_sample(blobs, "id", 40).toPandas()
    assert small == pytest.approx(plain_silhouette(kept[["x", "y"]].to_numpy(), kept["label"].to_numpy()))


def plain_ari(a, b):
    def pairs(values):
        return sum(n * (n - 1) / 2 for n in values)
    ks, ls = sorted(set(a)), sorted(set(b))
    table = np.array([[np.sum((a == k) & (b == j)) for j in ls] for k in ks])
    c, r, s, t = pairs(table.ravel()), pairs(table.sum(1)), pairs(table.sum(0)), pairs([len(a)])
    return (c - r * s / t) / ((r + s) / 2 - r * s / t)


def test_adjusted_rand(blobs):
    def ari(a, b):
        return M.adjusted_rand(blobs.select(F.expr(a).alias("a"), F.expr(b).alias("b")), "a", "b").first()[0]
    ids = np.arange(100)
    assert ari("label", "label") == 1.0 and ari("label", "2 - label") == 1.0
    assert ari("0", "0") == 1.0 and ari("id", "id") == 1.0 and ari("0", "label") == 0.0
    assert ari("label", "id % 3") == pytest.approx(plain_ari(LABELS, ids % 3))


def test_medians_and_standardising(spark):
    rows = [(i, None if i % 10 == 0 else float((i * 7) % 23), float(i), 3.0) for i in range(41)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double").repartition(3)
    fitted = preprocess.fit_preprocessor(df, ["b", "a", "c"], ["a"])
    assert fitted.outputs == ["z_a", "z_b", "z_c"]
    got = fitted.transform(df).orderBy("id").toPandas()
    a = np.array([np.nan if r[1] is None else r[1] for r in rows])
    assert fitted.medians["a"] == np.nanmedian(a) and fitted.medians["b"] == 20.0
    logged = np.log1p(np.where(np.isnan(a), np.nanmedian(a), a))
    assert np.allclose(got["z_a"], (logged - logged.mean()) / logged.std())
    assert np.allclose(got["z_b"], (np.arange(41) - 20) / np.arange(41).std()) and np.allclose(got["z_c"], 0)
    even = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4)], "v double")
    assert preprocess.column_medians(even, ["v"]) == {"v": 2.5}


def test_medians_with_a_value_that_most_rows_share(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 100 < 97, 1.0).otherwise(F.col("id").cast("double")).alias("hot"),
        F.when(F.col("id") % 3 > 0, F.col("id").cast("double")).alias("gaps"), F.lit(None).cast("double").alias("none"))
    plain = rows.toPandas().astype("float64").median()
    assert preprocess.column_medians(rows, ["hot", "gaps", "none"]) == {"hot": plain["hot"], "gaps": plain["gaps"], "none": None}


def test_missing_model_column(toy_features):
    with pytest.raises(KeyError):
        preprocess.select_model_frame(toy_features.drop("monetary"))
    assert preprocess.select_model_frame(toy_features).columns == preprocess.FEATURE_COLUMNS


@pytest.mark.parametrize("algorithm", ["kmeans", "minibatch_kmeans", "gaussian_mixture"])
def test_planted_clusters_are_found(blobs, algorithm):
    model = clustering.fit_clusterer(algorithm, blobs, ["x", "y"], "id", 3, n_init=2)
    found = model.assign(blobs)
    assert M.adjusted_rand(found, "label", "segment_id").first()[0] == 1.0
    assert found.columns == [*blobs.columns, "segment_id"]


def test_kmeans_assignment_and_cost(blobs):
    model = clustering.fit_kmeans(blobs, ["x", "y"], 3, n_init=2)
    got = model.with_distance(model.assign(blobs)).toPandas()
    d2 = ((got[["x", "y"]].to_numpy()[:, None] - np.array(model.centres)[None]) ** 2).sum(axis=2)
    assert (got["segment_id"] == d2.argmin(axis=1)).all() and np.allclose(got["d2"], d2.min(axis=1))
    assert got["d2"].sum() == pytest.approx(model.cost)
    assert clustering.fit_kmeans(blobs, ["x", "y"], 5, n_init=2).cost < model.cost


def test_ties_take_the_first_centre(spark):
    model = clustering.CentroidModel(["x"], [[1.0], [-1.0], [1.0]])
    assert model.assign(spark.createDataFrame([(0.0,), (2.0,)], "x double")).toPandas()["segment_id"].tolist() == [0, 0]


def test_mixture_likelihood(blobs):
    model = clustering.fit_gaussian_mixture(blobs, ["x", "y"], 3, "id")
    w, m, v = np.array(model.weights), np.array(model.means), np.array(model.variances)
    logs = np.log(w) - 0.5 * (((POINTS[:, None] - m) ** 2 / v).sum(2) + np.log(2 * np.pi * v).sum(1))
    total = np.log(np.exp(logs).sum(axis=1)).sum()
    assert model.log_likelihood == pytest.approx(total, abs=0.2)
    got = model.assign(blobs).orderBy("id").toPandas()["segment_id"]
    assert (got == logs.argmax(axis=1)).all()
    bic, aic = model.information_criteria(100)
    assert bic - aic == pytest.approx(14 * (math.log(100) - 2))
    # the criteria of other rows come from the likelihood of those rows
    few = logs[:50]
    n, level = model.likelihood_of(blobs.where("id < 50"))
    assert n == 50 and level == pytest.approx(np.log(np.exp(few).sum(axis=1)).sum())
    assert model.information_criteria(n, level)[1] == pytest.approx(28 - 2 * level)


def test_unknown_algorithm(blobs):
    with pytest.raises(ValueError):
        clustering.fit_clusterer("dbscan", blobs, ["x", "y"], "id", 3)
    with pytest.raises(ValueError):
        list(training.search_space({"dbscan": {"n_clusters": [3]}}))


def test_search_space():
    names = [s["run_name"] for s in training.search_space(training.SEARCH)]
    assert len(names) == 9 and names[0] == "kmeans_k4"
    assert names[3] == "minibatch_kmeans_k4_batch_size=1024" and names[8] == "gaussian_mixture_k6_covariance_type=diag"


def test_period_overlap(spark, blobs):
    a = blobs.withColumn("segment_id", F.col("label"))
    row = stability.period_stability(a, a.where("id >= 40"), "id").first()
    assert tuple(row) == (1.0, 60.0)
    few = stability.period_stability(a, a.where("id >= 60"), "id").first()
    assert tuple(few) == (None, 40.0)


def test_model_on_features(toy_features):
    model = scoring.fit_model(toy_features, "kmeans", 3, n_init=2)
    sizes = sorted(r["count"] for r in model.assign(toy_features).groupBy("segment_id").count().collect())
    assert sizes == [30, 30, 30]
    facts = scoring.signature_compatible(model, toy_features)
    assert facts["passed"] and facts["missing_column_raises"] and facts["n_predicted"] == 90
    assert not scoring.signature_compatible(model, toy_features, ["avg_freight"])["passed"]
    smoke = scoring.smoke_predict(model, toy_features)
    assert smoke["passed"] and smoke["n"] == 5
    with pytest.raises(AnalysisException):
        model.assign(toy_features.drop("monetary"))


def test_davies_bouldin_of_many_labels_in_tiles(spark, monkeypatch):
    """Two rows a label, its centre on a line with growing gaps, tiles of some forty labels."""
    monkeypatch.setattr(M, "TILE", 40)
    monkeypatch.setattr(M, "PAIRS", 64)
    points = [(k, float(k * k) + side * (1 + k % 3) / 4, float(k % 7)) for k in range(500) for side in (-1, 1)]
    df = spark.createDataFrame(points, "label int, x double, y double")
    xy = np.array([p[1:] for p in points])
    assert M.davies_bouldin(df, "label", ["x", "y"]).first()[0] == pytest.approx(plain_davies_bouldin(xy, np.array([p[0] for p in points])))


def test_davies_bouldin_of_fifty_thousand_labels(spark):
    """No task gets more than two tiles; labels far apart in pairs have a known worst neighbour."""
    n = 50_000
    rows = spark.range(2 * n).select(
        F.floor(F.col("id") / 2).alias("label"),
        (F.floor(F.col("id") / 4) * 100 + F.floor(F.col("id") / 2) % 2 * 10 + F.col("id") % 2 * 2).cast("double").alias("x"))
    # every centre has a spread of one and its nearest other centre ten away
    assert M.davies_bouldin(rows, "label", ["x"]).first()[0] == pytest.approx(0.2)
