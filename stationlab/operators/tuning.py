"""Grid search, tuning reports and stored models."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import Imputer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.indexing import bucket_of
from . import classify, evaluate as E
from .prepare import SEED, TRAIN_RATIO, Prepared

# Default grids.
LINEAR_GRID = {"regParam": (0.01, 0.1, 0.3), "elasticNetParam": (0.0, 0.5, 0.8), "maxIter": (10, 20, 50)}
BOOST_GRID = {"maxIter": (10, 20, 50), "maxDepth": (3, 5, 10), "stepSize": (0.05, 0.1, 0.2)}
FOREST_GRID = {"numTrees": (10, 20, 50), "maxDepth": (3, 5, 10)}
CLASSIFIERS = {
    "logistic_regression": (LogisticRegression, {}, LINEAR_GRID),
    "random_forest": (RandomForestClassifier, {"seed": SEED}, {**FOREST_GRID, "impurity": ("gini", "entropy")}),
    "gbt": (GBTClassifier, {"seed": SEED}, BOOST_GRID),
}
REGRESSORS = {
    "linear_regression": (LinearRegression, {}, LINEAR_GRID),
    "random_forest": (RandomForestRegressor, {"seed": SEED}, FOREST_GRID),
    "gbt": (GBTRegressor, {"seed": SEED}, BOOST_GRID),
}
FOLDS = 3


def _estimator(kinds, model_type: str, p: Prepared, grid: Mapping[str, Sequence] | None):
    if model_type not in kinds:
        raise ValueError(f"model_type must be one of {sorted(kinds)}")
    cls, fixed, default = kinds[model_type]
    est = cls(featuresCol=p.features_col, labelCol=p.label_col, **fixed)
    builder = ParamGridBuilder()
    for name, values in (grid or default).items():
        builder.addGrid(est.getParam(name), list(values))
    return est, builder.build()


def tune_classifier(
    p: Prepared,
    model_type: str = "logistic_regression",
    is_binary: bool = True,
    grid: Mapping[str, Sequence] | None = None,
    folds: int = FOLDS,
    fold_keys: Sequence[str] = (),
    parallelism: int = 4,
) -> E.ModelResult:
    """Cross-validation; with ``fold_keys`` the folds depend on the key only, not on row placement."""
    est, points = _estimator(CLASSIFIERS, model_type, p, grid)
    if is_binary:
        judge = BinaryClassificationEvaluator(labelCol=p.label_col, metricName="areaUnderROC")
    else:
        judge = MulticlassClassificationEvaluator(labelCol=p.label_col, metricName="f1")
    cv = CrossValidator(estimator=est, estimatorParamMaps=points, evaluator=judge, numFolds=folds, parallelism=parallelism, seed=SEED)
    with p.kept():
        train = p.train
        if fold_keys:
            train = train.withColumn("_fold", bucket_of(fold_keys, folds).cast("int"))
            cv.setFoldCol("_fold")
        model = cv.fit(train)
        predictions = model.bestModel.transform(p.test)
        metrics = classify.score(predictions, p.label_col, is_binary)
    return E.ModelResult(model, predictions, metrics, {"grid": points, "larger_is_better": True})


def tune_regressor(
    p: Prepared,
    model_type: str = "linear_regression",
    grid: Mapping[str, Sequence] | None = None,
    train_ratio: float = TRAIN_RATIO,
    parallelism: int = 4,
) -> E.ModelResult:
    """Train/validation split on rmse."""
    est, points = _estimator(REGRESSORS, model_type, p, grid)
    judge = RegressionEvaluator(labelCol=p.label_col, metricName="rmse")
    tvs = TrainValidationSplit(estimator=est, estimatorParamMaps=points, evaluator=judge, trainRatio=train_ratio, parallelism=parallelism, seed=SEED)
    with p.kept():
        model = tvs.fit(p.train)
        predictions = model.bestModel.transform(p.test)
        metrics = E.regression_metrics(predictions, p.label_col).first().asDict()
    return E.ModelResult(model, predictions, metrics, {"grid": points, "larger_is_better": False})


def tuning_report(result: E.ModelResult) -> DataFrame:
    """(params, score, is_best) for every grid point."""
    model, up = result.model, result.details["larger_is_better"]
    scores = [float(s) for s in (getattr(model, "avgMetrics", None) or model.validationMetrics)]
    best = scores.index(max(scores) if up else min(scores))
    rows = []
    for i, (point, s) in enumerate(zip(result.details["grid"], scores)):
        text = ", ".join(f"{p.name}={v}" for p, v in sorted(point.items(), key=lambda kv: kv[0].name))
        rows.append((text, s, i == best))
    return result.predictions.sparkSession.createDataFrame(rows, "params string, score double, is_best boolean")


def model_path(root: str, model_type: str, name: str) -> str:
    return f"{root.rstrip('/')}/models/{model_type}/{name}"


def save_model(model, root: str, name: str, model_type: str) -> str:
    """Store a model; a bare stage is wrapped so that loading needs no class name."""
    path = model_path(root, model_type, name)
    stored = model if isinstance(model, PipelineModel) else PipelineModel([model])
    stored.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession, root: str, name: str, model_type: str) -> PipelineModel:
    return PipelineModel.load(model_path(root, model_type, name))


@dataclass
class StoredPipeline:
    """A fitted chain from raw columns to predictions, with the input it was fitted on."""

    model: PipelineModel
    inputs: T.StructType

    def score(self, df: DataFrame) -> DataFrame:
        """Predictions for raw rows. The input columns must be there with their types; others are kept as they are."""
        have = {f.name: f.dataType for f in df.schema}
        wrong = [f"{f.name} {f.dataType.simpleString()}" for f in self.inputs if have.get(f.name) != f.dataType]
        if wrong:
            raise ValueError(f"input columns missing or of another type: {wrong}")
        return self.model.transform(df)


def fit_pipeline(df: DataFrame, numeric: Sequence[str], text: Sequence[str], estimator, scale: bool = True) -> StoredPipeline:
    """Fit indexers of text columns, mean imputation of numeric ones, assembly, scaling and ``estimator`` as one chain.

    The estimator reads ``features`` and its own label column; rows without a label are not fitted. Missing or unseen
    text gets an index of its own; numeric columns must be double or float.
    """
    label = estimator.getLabelCol()
    indexed, filled = [f"{c}_index" for c in text], [f"{c}_filled" for c in numeric]
    stages = [StringIndexer(inputCol=c, outputCol=i, handleInvalid="keep") for c, i in zip(text, indexed, strict=True)]
    if numeric:
        stages.append(Imputer(inputCols=list(numeric), outputCols=filled))
    stages.append(VectorAssembler(inputCols=[*filled, *indexed], outputCol="assembled" if scale else "features"))
    if scale:
        stages.append(StandardScaler(inputCol="assembled", outputCol="features", withMean=True, withStd=True))
    model = Pipeline(stages=[*stages, estimator.setFeaturesCol("features")]).fit(df.filter(F.col(label).isNotNull()))
    return StoredPipeline(model, T.StructType([df.schema[c] for c in (*numeric, *text)]))


def save_pipeline(fitted: StoredPipeline, spark: SparkSession, root: str, name: str) -> str:
    """Store the chain and its input schema as one artifact; the schema goes last."""
    path = model_path(root, "pipeline", name)
    fitted.model.write().overwrite().save(f"{path}/stages")
    spark.createDataFrame([(fitted.inputs.json(),)], "schema string").coalesce(1).write.mode("overwrite").text(f"{path}/inputs")
    return path


def load_pipeline(spark: SparkSession, root: str, name: str) -> StoredPipeline:
    """A stored chain with its input schema; an incomplete artifact is an error."""
    path = model_path(root, "pipeline", name)
    inputs = T.StructType.fromJson(json.loads(spark.read.text(f"{path}/inputs").first()[0]))
    return StoredPipeline(PipelineModel.load(f"{path}/stages"), inputs)
