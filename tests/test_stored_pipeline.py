"""A chain from raw columns to predictions, stored and loaded."""

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from stationlab.operators import tuning as T


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, float(i % 7) if i % 5 else None, float(i % 11), ["a", "b", None, "c"][i % 4], float(i % 2), float(i % 7) * 2 + (i % 4)) for i in range(120)]
    return spark.createDataFrame([*data, (500, 1.0, 1.0, "a", None, None)], "k int, x double, y double, t string, label double, value double")


def predictions(df):
    return {r.k: r.prediction for r in df.select("k", "prediction").collect()}


@pytest.mark.parametrize("make", [lambda: RandomForestClassifier(numTrees=5, seed=1), lambda: LinearRegression(labelCol="value")])
def test_round_trip(spark, rows, tmp_path, make):
    fitted = T.fit_pipeline(rows, ["x", "y"], ["t"], make())
    T.save_pipeline(fitted, spark, str(tmp_path), "one")
    again = T.load_pipeline(spark, str(tmp_path), "one")
    assert again.inputs == fitted.inputs
    got = predictions(again.score(rows))
    assert len(got) == 121 and got == predictions(fitted.score(rows))
    # unseen text, missing values and further columns
    odd = rows.limit(3).withColumn("t", F.lit("new")).withColumn("x", F.lit(None).cast("double")).withColumn("more", F.lit(1)).drop("label", "value")
    assert again.score(odd).filter("prediction IS NOT NULL").count() == 3


def test_input_is_checked(spark, rows, tmp_path):
    T.save_pipeline(T.fit_pipeline(rows, ["x"], [], LinearRegression(labelCol="value"), scale=False), spark, str(tmp_path), "two")
    again = T.load_pipeline(spark, str(tmp_path), "two")
    assert again.score(rows.select("k", "x")).count() == 121
    for wrong in (rows.drop("x"), rows.withColumn("x", F.col("x").cast("string"))):
        with pytest.raises(ValueError, match="x double"):
            again.score(wrong)
