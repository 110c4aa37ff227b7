"""What the checks of registered fits rest on, where a fit stops early."""

import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stationlab.operators import cluster as U, prepare as P, regress
from stationlab.queries import QUERIES, modelling

SF = "/root/testdata/sf0.001"


def noise(spark, n=600, seed=3):
    r = random.Random(seed)
    rows = [(i, r.random(), r.random(), r.random()) for i in range(n)]
    return spark.createDataFrame(rows, "k int, x double, z double, y double")


def test_bisecting_centres_are_of_the_rows_as_assigned(spark):
    r = U.bisecting_kmeans(P.prepare_clustering(noise(spark), ["x", "z"]), 4, max_iter=1)
    a = vector_to_array("scaledFeatures")
    got = {(c.cluster, c.feature): c.center for c in U.center_table(r, ["x", "z"]).collect()}
    cost = 0.0
    for row in r.predictions.groupBy("cluster").agg(*[f(a[j]).alias(f"{n}{c}") for j, c in enumerate("xz") for n, f in (("m", F.avg), ("v", F.var_pop))], F.count("*").alias("n")).collect():
        cost += row.n * (row.vx + row.vz)
        assert abs(got[row.cluster, "x"] - row.mx) < 1e-9 and abs(got[row.cluster, "z"] - row.mz) < 1e-9
    assert abs(r.metrics["cost"] - cost) < 1e-6 * cost


@pytest.mark.parametrize("name", ["decision_tree_regressor", "gbt_regressor"])
def test_features_that_tell_nothing_are_no_violation(spark, monkeypatch, name):
    p = P.prepare_regression(noise(spark), ["x", "z"], "y", ["k"])
    monkeypatch.setattr(modelling, "_targets", lambda s, d: p)
    assert getattr(regress, name)(p).metrics["r2"] < 0
    assert {r.check: r.value for r in QUERIES[name](spark, SF).collect()} == {"train_rows": p.train.count(), "test_rows": p.test.count(), "violations": 0}


def test_leaves_off_their_means_are_found(spark):
    p = P.prepare_regression(noise(spark), ["x", "z"], "y", ["k"])
    fitted = regress.decision_tree_regressor(p).model.transform(p.train)
    assert modelling._off_leaves(fitted, "label") == 0
    assert modelling._off_leaves(fitted.withColumn("prediction", F.col("prediction") + 0.01), "label") > 0


@pytest.mark.parametrize("label", ["1", "CAST(x > 0.5 AS INT)"])
def test_importances_of_one_label(spark, monkeypatch, label):
    p = P.prepare_classification(noise(spark).withColumn("l", F.expr(label)), ["x", "z", "y", "k"], "l", ["k"])
    monkeypatch.setattr(modelling, "_classes", lambda s, d: p)
    assert {r.check: r.value for r in QUERIES["feature_importance"](spark, SF).collect()} == {"train_rows": p.train.count(), "features": 4, "violations": 0}


def test_counted_rows_fit_as_all_rows(spark):
    rows = noise(spark).selectExpr("k", "CAST(x > 0.4 AS DOUBLE) AS a", "floor(1 + z * 3 + y * 2 * x) AS b", "IF(k % 7 = 0, NULL, floor(1 + y * 4)) AS c")
    counted = P.prepare_counted(rows, ["a"], ["b", "c"], ["k"])
    assert counted["b"].train.count() + counted["c"].test.count() < 150
    for label, p in counted.items():
        one, all_ = (regress.glm(q, "poisson", "log", reg_param=0.0, max_iter=50) for q in (p, P.prepare_regression(rows, ["a"], label, ["k"])))
        assert abs(one.model.coefficients[0] - all_.model.coefficients[0]) < 1e-9 and abs(one.model.intercept - all_.model.intercept) < 1e-9
        assert one.metrics == pytest.approx(all_.metrics, abs=1e-9)
