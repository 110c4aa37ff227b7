"""Grids of linear models from moments beside MLlib's fits of every point and fold."""

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression

from stationlab.functions.indexing import bucket_of
from stationlab.operators import evaluate as E, linear_path, prepare

REGS, MIXES = (0.0, 0.1, 1.0), (0.0, 0.5, 1.0)


@pytest.fixture(scope="module")
def prepared(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 4)) * [1, 10, 0.1, 1] + [0, 500, 3, 0]
    x[:, 3] = 7.0  # without spread
    y = x[:, 0] * 2 - x[:, 1] * 0.1 + rng.normal(size=300)
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))] + [(900, None, 1.0, 1.0, 1.0, 2.0)]
    return prepare.prepare_regression(spark.createDataFrame(rows, "k int, a double, b double, c double, d double, y double"), ["a", "b", "c", "d"], "y", ["k"])


def test_scores_equal_fits_by_fold(prepared):
    result = linear_path.tune_linear(prepared, ["k"], REGS, MIXES)
    train = prepared.train.withColumn("f", bucket_of(["k"], 3)).persist()
    scores = {(r, m): s for r, m, s in result.details["scores"]}
    assert len(scores) == 9
    for reg, mix in ((0.0, 0.0), (0.1, 0.0), (1.0, 0.0), (0.1, 0.5), (1.0, 0.5), (0.1, 1.0)):
        est = LinearRegression(featuresCol="features", labelCol="label", regParam=reg, elasticNetParam=mix, maxIter=200, tol=1e-12)
        errors = [E.regression_metrics(est.fit(train.filter(f"f <> {k}")).transform(train.filter(f"f = {k}")), "label").first().rmse for k in range(3)]
        assert scores[reg, mix] == pytest.approx(np.mean(errors), rel=1e-5), (reg, mix)
    report = linear_path.path_report(result).collect()
    assert len(report) == 9 and sum(r.is_best for r in report) == 1 and result.metrics["rmse"] < 2


def test_folds_without_rows(spark, prepared):
    few = prepare.Prepared(prepared.train.limit(0), prepared.test, "label", prepared.feature_cols, prepared.stages)
    with pytest.raises(ValueError):
        linear_path.tune_linear(few, ["k"])
