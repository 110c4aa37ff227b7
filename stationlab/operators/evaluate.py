"""Evaluation of prediction tables. Every statistic is an aggregate; predictions are never collected."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field as dc_field
from typing import Any

from pyspark import StorageLevel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, ClusteringEvaluator
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import attach_row
from .profile import value_counts


@dataclass
class ModelResult:
    """A fitted model, its predictions on held-out rows and its metrics."""

    model: Any
    predictions: DataFrame
    metrics: dict[str, float]
    details: dict[str, Any] = dc_field(default_factory=dict)

    def frame(self) -> DataFrame:
        return metric_frame(self.predictions.sparkSession, self.metrics)


def metric_frame(spark: SparkSession, metrics: dict[str, float]) -> DataFrame:
    """Metrics as rows (metric, value)."""
    return spark.createDataFrame([(k, None if v is None else float(v)) for k, v in metrics.items()], "metric string, value double")


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def _harmonic(p: Column, r: Column) -> Column:
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def binary_confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """tp, fp, tn, fn with accuracy, precision, recall and f1 (0 when a denominator is 0), in one row."""
    y, p = F.col(label), F.col(prediction)
    counts = df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    rates = counts.select(
        "*",
        _ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
    )
    return rates.withColumn("f1", _harmonic(F.col("precision"), F.col("recall")))


def binary_auc(df: DataFrame, label: str = "label", score: str = "rawPrediction", bins: int = 0) -> DataFrame:
    """Areas under the ROC and precision-recall curves, one row. ``bins=0`` uses every distinct score."""
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=score, numBins=bins)
    scored = df.select(label, score).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        roc = ev.evaluate(scored, {ev.metricName: "areaUnderROC"})
        pr = ev.evaluate(scored, {ev.metricName: "areaUnderPR"})
    finally:
        scored.unpersist()
    return df.sparkSession.createDataFrame([(roc, pr)], "auc_roc double, auc_pr double")


def evaluate_binary(df: DataFrame, label: str = "label", score: str = "rawPrediction", prediction: str = "prediction") -> dict[str, float]:
    """All binary metrics of one prediction table."""
    out = binary_confusion(df, label, prediction).first().asDict()
    out.update(binary_auc(df, label, score).first().asDict())
    return out


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Row count per (label, prediction) that occurs."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count("*").alias("count"))


def class_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, f1 and support for every class seen in the labels."""
    cells = confusion_matrix(df, label, prediction)
    sides = cells.select(
        F.inline(
            F.array(
                F.struct(F.col("label").alias("class"), F.col("count").alias("actual"), F.lit(0).cast("long").alias("predicted"), F.lit(0).cast("long").alias("hit")),
                F.struct(
                    F.col("prediction").alias("class"),
                    F.lit(0).cast("long").alias("actual"),
                    F.col("count").alias("predicted"),
                    F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(F.lit(0)).alias("hit"),
                ),
            )
        )
    )
    sums = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "hit")]).filter("actual > 0")
    rates = sums.select(
        "class",
        _ratio(F.col("hit"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hit"), F.col("actual")).alias("recall"),
        F.col("actual").alias("support"),
        "hit",
    )
    return rates.withColumn("f1", _harmonic(F.col("precision"), F.col("recall"))).select("class", "precision", "recall", "f1", "support", "hit")


def multiclass_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and support-weighted precision, recall and f1, one row."""
    per = class_metrics(df, label, prediction)
    n = F.sum("support")

    def weighted(c):
        return F.sum(F.col(c) * F.col("support")) / n

    return per.agg(
        (F.sum("hit") / n).alias("accuracy"),
        weighted("f1").alias("f1"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
    )


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction", weight: str | None = None) -> DataFrame:
    """rmse, mae, r2, mean error (prediction - label), mse and mape (%, labels other than 0), one row.

    A row with a ``weight`` stands for so many rows.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    e = p - y
    known = df.filter(y.isNotNull() & p.isNotNull())
    if weight is None:
        avg, var = F.avg, F.var_pop(y)
    else:
        w = F.col(weight)

        def avg(c):
            return F.sum(c * w) / F.sum(F.when(c.isNotNull(), w))

        known = attach_row(known, known.agg(avg(y).alias("mean")), "_of")
        var = avg((y - F.col("_of.mean")) ** 2)
    row = known.agg(
        avg(e * e).alias("mse"),
        avg(F.abs(e)).alias("mae"),
        avg(e).alias("mean_error"),
        (avg(F.when(y != 0, F.abs(e / y))) * 100).alias("mape"),
        var.alias("_var"),
    )
    return row.select(
        F.sqrt("mse").alias("rmse"),
        "mae",
        F.when(F.col("_var") > 0, 1 - F.col("mse") / F.col("_var")).alias("r2"),
        "mean_error",
        "mse",
        "mape",
    )


def residuals(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Add ``residual`` = label - prediction."""
    return df.withColumn("residual", F.col(label) - F.col(prediction))


def prediction_bounds(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Joint min and max of labels and predictions, one row."""
    return df.agg(
        F.least(F.min(label), F.min(prediction)).alias("lo"), F.greatest(F.max(label), F.max(prediction)).alias("hi")
    )


def cluster_sizes(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Rows and share per cluster."""
    return value_counts(df, prediction).withColumnsRenamed({"value": "cluster", "count": "size"}).orderBy("cluster")


def silhouette(df: DataFrame, features: str = "features", prediction: str = "prediction") -> float:
    """Mean silhouette with squared Euclidean distance, from per-cluster sums (one pass per cluster set)."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=prediction).evaluate(df)


def clustering_metrics(df: DataFrame, features: str = "features", prediction: str = "prediction") -> DataFrame:
    """Sizes and shares per cluster with the number of clusters and the overall silhouette."""
    sizes = cluster_sizes(df, prediction)
    s = silhouette(df, features, prediction)
    d = attach_row(sizes, df.agg(F.count_distinct(prediction).alias("k")), "_s")
    return d.select("cluster", "size", "share", F.col("_s.k").alias("clusters"), F.lit(s).alias("silhouette"))


# Metrics that are better when smaller.
LOWER_IS_BETTER = ("rmse", "mae", "mse", "mape", "cost")


def compare_models(long: DataFrame, metrics: Sequence[str], sort_by: str | None = None) -> DataFrame:
    """One row per model from rows (model, metric, value); a metric a model lacks stays NULL."""
    cells = [F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in metrics]
    out = long.groupBy("model").agg(*cells)
    if sort_by:
        c = F.col(sort_by)
        out = out.orderBy(c.asc_nulls_last() if sort_by in LOWER_IS_BETTER else c.desc_nulls_last(), "model")
    return out


def model_weights(model: Any) -> list[float]:
    """One weight per feature: tree importance, |coefficient|, or the norm over classes."""
    stage = model.stages[-1] if hasattr(model, "stages") else model
    if hasattr(stage, "featureImportances"):
        return [float(v) for v in stage.featureImportances.toArray()]
    if getattr(stage, "numClasses", 2) > 2 and hasattr(stage, "coefficientMatrix"):
        m = stage.coefficientMatrix.toArray()
        return [float((m[:, j] ** 2).sum() ** 0.5) for j in range(m.shape[1])]
    if hasattr(stage, "coefficients"):
        return [abs(float(v)) for v in stage.coefficients.toArray()]
    raise ValueError(f"{type(stage).__name__} has no feature weights")


def feature_importance(spark: SparkSession, model: Any, feature_cols: Sequence[str], top: int | None = None) -> DataFrame:
    """(feature, importance), largest first: one row per model feature."""
    pairs = sorted(zip(feature_cols, model_weights(model)), key=lambda x: (-x[1], x[0]))
    return spark.createDataFrame(pairs[:top] if top else pairs, "feature string, importance double")


def sample_predictions(df: DataFrame, keys: Sequence[str], columns: Sequence[str] = ("label", "prediction"), n: int = 10) -> DataFrame:
    """The first rows by key with label, prediction and the like."""
    return df.select(*keys, *columns).orderBy(*keys).limit(n)


def evaluation_report(result: ModelResult, feature_cols: Sequence[str] | None = None, keys: Sequence[str] = (), label: str = "label") -> dict[str, DataFrame]:
    """Metrics, feature importance (when the model has it) and sample predictions."""
    spark = result.predictions.sparkSession
    report = {"metrics": result.frame()}
    if feature_cols:
        try:
            report["importance"] = feature_importance(spark, result.model, feature_cols)
        except ValueError:
            pass
    if keys:
        extra = [c for c in (label, "prediction", "probability") if c in result.predictions.columns]
        report["samples"] = sample_predictions(result.predictions, keys, extra)
    return report
