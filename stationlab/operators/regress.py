"""Regressors: fit on the training side, predict and score the test side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession

from . import evaluate as E
from .classify import compare_results
from .prepare import SEED, Prepared

# Link functions each family of the generalized model allows.
GLM_LINKS = {
    "gaussian": ("identity", "log", "inverse"),
    "binomial": ("logit", "probit", "cloglog"),
    "poisson": ("log", "identity", "sqrt"),
    "gamma": ("inverse", "identity", "log"),
}


def train(estimator, p: Prepared) -> E.ModelResult:
    model = estimator.fit(p.train)
    predictions = model.transform(p.test)
    return E.ModelResult(model, predictions, E.regression_metrics(predictions, p.label_col, weight=p.weight_col).first().asDict())


def _cols(p: Prepared) -> dict[str, str]:
    cols = {"featuresCol": p.features_col, "labelCol": p.label_col}
    return cols | ({"weightCol": p.weight_col} if p.weight_col else {})


def linear_regression(p: Prepared, max_iter: int = 10, reg_param: float = 0.3, elastic_net: float = 0.8) -> E.ModelResult:
    return train(LinearRegression(maxIter=max_iter, regParam=reg_param, elasticNetParam=elastic_net, **_cols(p)), p)


def coefficient_table(spark: SparkSession, model, feature_cols) -> DataFrame:
    """(feature, coefficient) with the intercept as the last row."""
    rows = [(n, float(c)) for n, c in zip(feature_cols, model.coefficients.toArray())]
    return spark.createDataFrame([*rows, ("intercept", float(model.intercept))], "feature string, coefficient double")


def decision_tree_regressor(p: Prepared, max_depth: int = 5) -> E.ModelResult:
    return train(DecisionTreeRegressor(maxDepth=max_depth, seed=SEED, **_cols(p)), p)


def random_forest_regressor(p: Prepared, num_trees: int = 20, max_depth: int = 5) -> E.ModelResult:
    return train(RandomForestRegressor(numTrees=num_trees, maxDepth=max_depth, seed=SEED, **_cols(p)), p)


def gbt_regressor(p: Prepared, max_iter: int = 10, max_depth: int = 5) -> E.ModelResult:
    return train(GBTRegressor(maxIter=max_iter, maxDepth=max_depth, seed=SEED, **_cols(p)), p)


def glm(p: Prepared, family: str = "gaussian", link: str = "identity", reg_param: float = 0.3, max_iter: int = 10) -> E.ModelResult:
    """Generalized linear model; the family must allow the link."""
    if link not in GLM_LINKS.get(family, ()):
        raise ValueError(f"family {family!r} takes links {GLM_LINKS.get(family)}, not {link!r}")
    est = GeneralizedLinearRegression(family=family, link=link, regParam=reg_param, maxIter=max_iter, **_cols(p))
    return train(est, p)


REGRESSORS: dict[str, Callable[[Prepared], E.ModelResult]] = {
    "linear_regression": linear_regression,
    "decision_tree": decision_tree_regressor,
    "random_forest": random_forest_regressor,
    "gbt": gbt_regressor,
    "glm": glm,
}


def compare_regressors(p: Prepared, names: tuple[str, ...] = tuple(REGRESSORS)) -> DataFrame:
    """Fit several regressors on the same kept rows: (model, metric, value)."""
    with p.kept():
        return compare_results({n: REGRESSORS[n](p) for n in names})
