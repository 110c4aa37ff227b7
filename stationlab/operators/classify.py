"""Classifiers: fit on the training side, predict and score the test side."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from . import evaluate as E
from .prepare import SEED, Prepared


def _classes(p: Prepared) -> int:
    return int(p.train.agg(F.max(p.label_col)).first()[0]) + 1


def score(predictions: DataFrame, label: str, binary: bool = False) -> dict[str, float]:
    """Accuracy and weighted scores; areas under the curves for a binary model with raw scores."""
    if not (binary and "rawPrediction" in predictions.columns):
        return E.multiclass_metrics(predictions, label).first().asDict()
    # three passes over the predictions: keep the columns they read
    kept = predictions.select(label, "prediction", "rawPrediction").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return {**E.multiclass_metrics(kept, label).first().asDict(), **E.binary_auc(kept, label).first().asDict()}
    finally:
        kept.unpersist()


def train(estimator, p: Prepared, binary: bool = False) -> E.ModelResult:
    model = estimator.fit(p.train)
    predictions = model.transform(p.test)
    return E.ModelResult(model, predictions, score(predictions, p.label_col, binary))


def _cols(p: Prepared) -> dict[str, str]:
    return {"featuresCol": p.features_col, "labelCol": p.label_col}


def logistic_regression(p: Prepared, multiclass: bool = False, max_iter: int = 20, reg_param: float = 0.3, elastic_net: float = 0.8) -> E.ModelResult:
    family = "multinomial" if multiclass else "auto"
    est = LogisticRegression(maxIter=max_iter, regParam=reg_param, elasticNetParam=elastic_net, family=family, **_cols(p))
    return train(est, p, binary=not multiclass)


def decision_tree_classifier(p: Prepared, max_depth: int = 5) -> E.ModelResult:
    return train(DecisionTreeClassifier(maxDepth=max_depth, seed=SEED, **_cols(p)), p)


def random_forest_classifier(p: Prepared, num_trees: int = 20, max_depth: int = 5) -> E.ModelResult:
    return train(RandomForestClassifier(numTrees=num_trees, maxDepth=max_depth, seed=SEED, **_cols(p)), p)


def gbt_classifier(p: Prepared, max_iter: int = 10, max_depth: int = 5) -> E.ModelResult:
    """Boosted trees, two classes only."""
    if (n := _classes(p)) > 2:
        raise ValueError(f"boosted trees need labels 0 and 1, found {n} classes; use one_vs_rest")
    return train(GBTClassifier(maxIter=max_iter, maxDepth=max_depth, seed=SEED, **_cols(p)), p)


def naive_bayes(p: Prepared, smoothing: float = 1.0, model_type: str | None = None) -> E.ModelResult:
    """Multinomial when no training feature is negative, else Gaussian."""
    if model_type is None:
        smallest = p.train.select(F.array_min(vector_to_array(F.col(p.features_col))).alias("m")).agg(F.min("m")).first()[0]
        model_type = "multinomial" if smallest is not None and smallest >= 0 else "gaussian"
    result = train(NaiveBayes(smoothing=smoothing, modelType=model_type, **_cols(p)), p)
    result.details["model_type"] = model_type
    return result


def one_vs_rest(p: Prepared, base=None, parallelism: int = 4) -> E.ModelResult:
    base = base or LogisticRegression(maxIter=10, regParam=0.1)
    return train(OneVsRest(classifier=base, parallelism=parallelism, **_cols(p)), p)


def compare_results(results: dict[str, E.ModelResult]) -> DataFrame:
    """Rows (model, metric, value)."""
    parts = [r.frame().select(F.lit(n).alias("model"), "metric", "value") for n, r in results.items()]
    return reduce(DataFrame.unionByName, parts)


CLASSIFIERS: dict[str, Callable[[Prepared], E.ModelResult]] = {
    "logistic_regression": logistic_regression,
    "random_forest": random_forest_classifier,
    "naive_bayes": naive_bayes,
    "gbt": gbt_classifier,
}


def compare_classifiers(p: Prepared, names: tuple[str, ...] = tuple(CLASSIFIERS)) -> DataFrame:
    """Fit several classifiers on the same kept rows; boosted trees know two classes, so above that they fit one against the rest."""
    two = _classes(p) <= 2
    with p.kept():
        results = {}
        for n in names:
            if n == "gbt" and not two:
                results[n] = one_vs_rest(p, GBTClassifier(maxIter=10, maxDepth=5, seed=SEED))
            elif n == "logistic_regression":
                results[n] = logistic_regression(p, multiclass=not two)
            else:
                results[n] = CLASSIFIERS[n](p)
        return compare_results(results)
