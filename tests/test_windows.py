"""Chunked windows equal the plain window, whatever the chunk size."""

import re

import pytest
from pyspark.sql import Window, functions as F

from stationlab.functions.windows import over_range, over_rows, row_halo


@pytest.fixture(scope="module")
def series(spark):
    rows = []
    for key, step, n in (("hot", 1, 120), ("gaps", 7, 23), ("one", 1, 1)):
        for i in range(n):
            if key == "gaps" and i % 5 == 3:
                continue
            rows.append((key, 1900 + i * step, float((i * 37) % 11) if i % 9 else None))
    return spark.createDataFrame(rows, "k string, t int, v double").repartition(5)


def rows_of(df):
    return sorted(map(tuple, df.select("k", "t", "v", *[c for c in df.columns if c not in "ktv"]).collect()), key=str)


@pytest.mark.parametrize("chunk", [1, 2, 3, 10, 64, 5000])
def test_rows_before_and_after(series, chunk):
    def stage(w):
        return {
            "lag1": F.lag("v", 1).over(w),
            "lag4": F.lag("v", 4).over(w),
            "lead2": F.lead("v", 2).over(w),
            "avg": F.round(F.avg("v").over(w.rowsBetween(-5, -1)), 9),
            "cnt": F.count("v").over(w.rowsBetween(-3, 3)),
        }

    plain = series.withColumns(stage(Window.partitionBy("k").orderBy("t")))
    assert rows_of(over_rows(series, ["k"], "t", [stage], before=5, after=3, chunk=chunk)) == rows_of(plain)


@pytest.mark.parametrize("chunk", [1, 4, 1000])
def test_second_stage_sees_first(series, chunk):
    def first(w):
        return {"d1": F.col("v") - F.lag("v").over(w)}

    def second(w):
        return {"d2": F.col("d1") - F.lag("d1").over(w)}

    w = Window.partitionBy("k").orderBy("t")
    plain = series.withColumns(first(w)).withColumns(second(w))
    assert rows_of(over_rows(series, ["k"], "t", [first, second], before=2, chunk=chunk)) == rows_of(plain)


@pytest.mark.parametrize("chunk", [1, 2, 7, 50, 5000])
@pytest.mark.parametrize("span", [0, 3, 20])
def test_range(series, chunk, span):
    def stage(w):
        return {"n": F.count("v").over(w), "m": F.round(F.avg("v").over(w), 9)}

    plain = series.withColumns(stage(Window.partitionBy("k").orderBy("t").rangeBetween(-span, span)))
    assert rows_of(over_range(series, ["k"], "t", stage, span, chunk)) == rows_of(plain)


def test_no_key_and_null_time(spark):
    df = spark.createDataFrame([(None, 1.0), (3, 2.0), (1, 3.0), (2, 4.0)], "t int, v double")
    out = over_rows(df, [], "t", [lambda w: {"p": F.lag("v").over(w)}], before=1, chunk=2)
    got = {r.t: r.p for r in out.collect()}
    assert got[2] == 3.0 and got[3] == 4.0 and len(got) == 4


def test_bounded_partitions(spark):
    """No window of the main path is partitioned by the key alone or not at all."""
    df = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").cast("int").alias("t"), F.rand(1).alias("v"))
    out = over_rows(df, ["k"], "t", [lambda w: {"p": F.lag("v").over(w)}], before=1, chunk=100)
    rows = out.withColumn("pid", F.spark_partition_id()).groupBy("pid").count().collect()
    assert max(r["count"] for r in rows) < 600


def test_hot_series_with_long_frames(spark):
    """One series holds 90 % of the rows, many of them at the same moment, and frames are 300 rows long."""
    n = 20_000
    hot = F.when(F.col("id") % 10 == 0, F.lit("cold")).otherwise(F.lit("hot"))
    df = spark.range(n).select(hot.alias("k"), F.when(F.col("id") < 8000, 3).otherwise(F.col("id")).cast("int").alias("t"), F.col("id").cast("double").alias("v"))
    out = over_rows(df, ["k"], "t", [lambda w: {"n": F.count("v").over(w.rowsBetween(-300, -1))}], before=300)
    rows = out.select("k", "n").groupBy("k").agg(F.count("*").alias("rows"), F.sum("n").alias("n")).collect()
    for r in rows:  # row i of a series has min(i, 300) rows before it
        assert r["n"] == sum(min(i, 300) for i in range(r["rows"]))
    assert sum(r["rows"] for r in rows) == n
    # with small chunks no group of a window has more than a chunk and its halo
    halo = row_halo(df, ["k"], "t", 300, chunk=500)
    assert halo.groupBy("k", "_chunk").count().agg(F.max("count")).first()[0] <= 800
    assert halo.count() <= n * (1 + 300 / 500) + 800


@pytest.mark.parametrize("keys", [["k"], []])
def test_no_window_by_the_key_alone(spark, keys):
    df = spark.range(500).select(F.lit("hot").alias("k"), F.col("id").cast("int").alias("t"), F.rand(1).alias("v"))
    plan = over_rows(df, keys, "t", [lambda w: {"p": F.lag("v", 3).over(w)}], before=3)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "_chunk" in plan
    assert len(re.findall(r"hashpartitioning\(", plan)) == 1 and re.search(r"hashpartitioning\([^)]*_chunk", plan)
