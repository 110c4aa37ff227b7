"""Clustering: fits, choice of k, cluster profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import attach_row, quoted
from . import evaluate as E
from .prepare import SEED

CLUSTER = "cluster"


def _fit(estimator, df: DataFrame, features: str) -> E.ModelResult:
    """Fit on kept rows: the fit is iterative and the score reads the rows again."""
    kept = df.select(features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = estimator.setFeaturesCol(features).setPredictionCol(CLUSTER).fit(kept)
        clustered = model.transform(kept)
        metrics = {"silhouette": E.silhouette(clustered, features, CLUSTER)}
        details = _of_rows(clustered, features, model.clusterCenters()) if isinstance(estimator, BisectingKMeans) else {}
    finally:
        kept.unpersist()
    out = model.transform(df)
    if isinstance(estimator, (KMeans, BisectingKMeans)):
        metrics["cost"] = details.get("cost", model.summary.trainingCost)
    return E.ModelResult(model, out, metrics, details)


def _of_rows(clustered: DataFrame, features: str, centers: list) -> dict:
    """Centres and cost of the clusters as assigned; one row a cluster comes to the driver."""
    parts = Summarizer.metrics("mean", "variance", "count").summary(F.col(features)).alias("s")
    rows = clustered.groupBy(CLUSTER).agg(parts).select(CLUSTER, "s.*").collect()
    found = {r[CLUSTER]: r["mean"].toArray() for r in rows}
    cost = sum(float(r["variance"].toArray().sum()) * (r["count"] - 1) for r in rows)
    return {"centers": [found.get(i, c) for i, c in enumerate(centers)], "cost": cost}


def _features(use_scaled: bool) -> str:
    return "scaledFeatures" if use_scaled else "features"


def kmeans(df: DataFrame, k: int = 3, use_scaled: bool = True, max_iter: int = 20) -> E.ModelResult:
    est = KMeans(k=k, initMode="k-means||", initSteps=5, tol=1e-4, maxIter=max_iter, seed=SEED)
    return _fit(est, df, _features(use_scaled))


SHIFT, SHIFTED = 1.0, "_shifted"


def bisecting_kmeans(df: DataFrame, k: int = 3, use_scaled: bool = True, max_iter: int = 20) -> E.ModelResult:
    """Bisecting fit. Standardized rows are moved off the origin first.

    The fit splits a cluster by moving its centre by a fraction of the centre's length. The first centre
    of standardized rows is the origin, so nothing would be split. Moving all rows alike changes neither
    clusters nor costs; ``center_table`` moves the centres back.

    A fit that ends at ``max_iter`` moves its centres after its last assignment, so its own centres and cost belong to
    clusters that are not returned. Those reported here are of the rows as they are assigned; the model keeps its own.
    """
    est = BisectingKMeans(k=k, maxIter=max_iter, seed=SEED)
    if not use_scaled:
        return _fit(est, df, _features(False))
    moved = F.transform(vector_to_array(_features(True)), lambda x: x + F.lit(SHIFT))
    r = _fit(est, df.withColumn(SHIFTED, array_to_vector(moved)), SHIFTED)
    r.predictions = r.predictions.drop(SHIFTED)
    r.details["shift"] = SHIFT
    return r


def gaussian_mixture(df: DataFrame, k: int = 3, use_scaled: bool = True, max_iter: int = 20) -> E.ModelResult:
    return _fit(GaussianMixture(k=k, maxIter=max_iter, seed=SEED), df, _features(use_scaled))


METHODS = {"kmeans": kmeans, "bisecting_kmeans": bisecting_kmeans, "gaussian_mixture": gaussian_mixture}


def center_table(result: E.ModelResult, feature_cols: Sequence[str]) -> DataFrame:
    """(cluster, feature, center): k x features rows."""
    centers = result.details.get("centers") or result.model.clusterCenters()
    shift = result.details.get("shift", 0.0)
    rows = [(i, f, float(v) - shift) for i, c in enumerate(centers) for f, v in zip(feature_cols, c)]
    return result.predictions.sparkSession.createDataFrame(rows, "cluster int, feature string, center double")


def optimal_k(df: DataFrame, method: str = "kmeans", k_range: tuple[int, int] = (2, 10), use_scaled: bool = True) -> DataFrame:
    """Silhouette per k (both ends included) and which is best, the smallest k on ties."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {sorted(METHODS)}")
    kept = df.select(_features(use_scaled)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        scores = [(k, float(METHODS[method](kept, k, use_scaled).metrics["silhouette"])) for k in range(k_range[0], k_range[1] + 1)]
    finally:
        kept.unpersist()
    best = max(scores, key=lambda s: (s[1], -s[0]))[0]
    return df.sparkSession.createDataFrame([(k, s, k == best) for k, s in scores], "k int, silhouette double, is_best boolean")


def cluster_profile(df: DataFrame, feature_cols: Sequence[str], cluster: str = CLUSTER) -> DataFrame:
    """Per cluster and feature: size, percent, count, mean, stddev, min, max. One grouped pass."""
    exprs = [F.count("*").alias("size")]
    for i, c in enumerate(feature_cols):
        q = quoted(c)
        exprs += [
            F.expr(f"count({q}) AS count__{i}"),
            F.expr(f"avg({q}) AS mean__{i}"),
            F.expr(f"stddev_samp({q}) AS stddev__{i}"),
            F.expr(f"min({q}) AS min__{i}"),
            F.expr(f"max({q}) AS max__{i}"),
        ]
    grouped = df.groupBy(F.col(cluster).alias("cluster")).agg(*exprs)
    grouped = attach_row(grouped, df.agg(F.count("*").alias("rows")), "_all")
    parts = ("count", "mean", "stddev", "min", "max")
    cells = ", ".join(
        f"named_struct('feature', '{c}', " + ", ".join(f"'{p}', {p}__{i}" for p in parts) + ")" for i, c in enumerate(feature_cols)
    )
    return grouped.selectExpr("cluster", "size", "100D * size / _all.rows AS percent", f"inline(array({cells}))")


def join_clusters(clustered: DataFrame, original: DataFrame, keys: Sequence[str], cluster: str = CLUSTER) -> DataFrame:
    """Bring the cluster back to the original rows by a unique key."""
    return original.join(clustered.select(*keys, F.col(cluster)), list(keys))
