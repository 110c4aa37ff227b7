"""Feature selection and principal components."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import PCA, UnivariateFeatureSelector
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import DataFrame, functions as F

from .evaluate import model_weights
from .prepare import assemble_features


@dataclass
class Selection:
    """Chosen features, best first, and the input with ``selectedFeatures``."""

    features: list[str]
    data: DataFrame

    def frame(self) -> DataFrame:
        return self.data.sparkSession.createDataFrame([(i + 1, f) for i, f in enumerate(self.features)], "rank int, feature string")


def _selected(df: DataFrame, names: list[str]) -> Selection:
    return Selection(names, assemble_features(df, names, "selectedFeatures"))


def chi_square_scores(df: DataFrame, feature_cols: Sequence[str], label_col: str) -> DataFrame:
    """Independence test of every categorical feature against the label: (feature, statistic, p_value, dof)."""
    v = assemble_features(df, feature_cols).select("features", F.col(label_col).cast("double").alias("label"))
    names = F.array(*[F.lit(c) for c in feature_cols])
    return ChiSquareTest.test(v, "features", "label", True).select(
        names[F.col("featureIndex")].alias("feature"),
        "statistic",
        F.col("pValue").alias("p_value"),
        F.col("degreesOfFreedom").alias("dof"),
    )


def select_chi_square(df: DataFrame, feature_cols: Sequence[str], label_col: str, num_top_features: int = 10) -> Selection:
    """The features least independent of a categorical label: lowest p-value, then largest statistic."""
    ranked = chi_square_scores(df, feature_cols, label_col).orderBy("p_value", F.desc("statistic"), "feature")
    return _selected(df, [r.feature for r in ranked.limit(num_top_features).collect()])


def select_univariate(
    df: DataFrame,
    feature_cols: Sequence[str],
    label_col: str,
    feature_type: str = "continuous",
    label_type: str = "continuous",
    num_top_features: int = 10,
) -> Selection:
    """Best features by F-test (continuous label), ANOVA (categorical label) or chi-square (both categorical)."""
    v = assemble_features(df, feature_cols).withColumn("_label", F.col(label_col).cast("double"))
    selector = UnivariateFeatureSelector(featuresCol="features", labelCol="_label", outputCol="selectedFeatures", selectionMode="numTopFeatures")
    selector = selector.setFeatureType(feature_type).setLabelType(label_type).setSelectionThreshold(num_top_features)
    model = selector.fit(v)
    return Selection([feature_cols[i] for i in sorted(model.selectedFeatures)], model.transform(v).drop("_label"))


def model_ranking(df: DataFrame, feature_cols: Sequence[str], label_col: str, model_type: str = "classification") -> list[tuple[str, float]]:
    """|coefficient| per feature from a linear or logistic fit, largest first."""
    v = assemble_features(df, feature_cols).withColumn("_label", F.col(label_col).cast("double"))
    if model_type == "classification":
        est = LogisticRegression(featuresCol="features", labelCol="_label", maxIter=10, standardization=True)
    elif model_type == "regression":
        est = LinearRegression(featuresCol="features", labelCol="_label", maxIter=10, standardization=True)
    else:
        raise ValueError(f"unknown model_type {model_type!r}")
    return sorted(zip(feature_cols, model_weights(est.fit(v))), key=lambda x: (-x[1], x[0]))


def select_by_model(df: DataFrame, feature_cols: Sequence[str], label_col: str, model_type: str = "classification", num_top_features: int = 10) -> Selection:
    ranked = model_ranking(df, feature_cols, label_col, model_type)
    return _selected(df, [f for f, _ in ranked[:num_top_features]])


def pca(df: DataFrame, feature_cols: Sequence[str], num_components: int = 5) -> tuple[DataFrame, DataFrame, PCA]:
    """Projection ``pcaFeatures``, the table (component, variance, cumulative) and the model."""
    v = assemble_features(df, feature_cols)
    model = PCA(k=num_components, inputCol="features", outputCol="pcaFeatures").fit(v)
    total, rows = 0.0, []
    for i, x in enumerate(model.explainedVariance.toArray()):
        total += float(x)
        rows.append((i + 1, float(x), total))
    table = df.sparkSession.createDataFrame(rows, "component int, variance double, cumulative double")
    return model.transform(v), table, model
