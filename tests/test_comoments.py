"""Co-moments of all column pairs against numpy, with missing values, far offsets and odd columns."""

import numpy as np
import pytest

from stationlab.functions.comoments import PARTS, pair_moments
from stationlab.operators import relations


def columns(rng, n=500):
    a = rng.normal(size=n)
    out = {"a": a, "b": a * 2 + rng.normal(size=n), "far": 1e9 + rng.normal(size=n), "flat": np.full(n, 0.1), "whole": rng.integers(0, 5, n).astype(float), "gone": np.full(n, np.nan)}
    out["holes"] = np.where(rng.random(n) < 0.5, np.nan, a + 5)
    out["rare"] = np.where(rng.random(n) < 0.99, np.nan, a)
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_against_numpy(spark, parts):
    cols = columns(np.random.default_rng(parts))
    names = list(cols)
    rows = [tuple(None if np.isnan(x) and k % 2 else float(x) for k, x in enumerate(r)) for r in zip(*cols.values(), strict=True)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(parts)
    got = {r.i: r for r in pair_moments(df, names).collect()}
    assert sorted(got) == list(range(len(names)))
    for i, x in enumerate(cols.values()):
        for k, y in enumerate(cols.values()):
            both = ~np.isnan(x) & ~np.isnan(y)
            assert got[i].n[k] == both.sum()
            if not both.any():
                continue
            u, v = x[both] - x[both].mean(), y[both] - y[both].mean()
            want = [x[both].mean(), y[both].mean(), u @ u, v @ v, u @ v]
            assert np.allclose([got[i][c][k] for c in PARTS[1:]], want, rtol=1e-5, atol=1e-5), (names[i], names[k])
    flat = names.index("flat")
    assert got[flat].dev[flat] == 0
    pairs = {(r.feature1, r.feature2): r.correlation for r in relations.correlation_pairs(df, limit=None).collect()}
    assert not any("flat" in p or "gone" in p for p in pairs)
    assert abs(pairs["a", "far"] - np.corrcoef(cols["a"], cols["far"])[0, 1]) < 1e-6 and abs(pairs["a", "holes"] - 1) < 1e-12


def test_empty_and_infinite(spark):
    none = spark.createDataFrame([], "a double, b int")
    assert pair_moments(none, ["a", "b"]).collect() == [] and relations.correlation_pairs(none).collect() == []
    df = spark.createDataFrame([(1.0, 1, 2.0), (2.0, 2, 1.0), (float("inf"), 5, 0.5)], "a double, b int, c double")
    assert [(r.feature1, r.feature2) for r in relations.correlation_pairs(df).collect()] == [("b", "c")]


def test_plan_repeats_no_row(spark):
    df = spark.range(100).selectExpr(*[f"id * {k + 1} % 101 AS c{k}" for k in range(100)])
    plan = relations._all_pairs(df, df.columns)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("MapInArrow") and plan.count("Generate") == 1
    assert relations.correlation_pairs(df, limit=None).count() == 4950


def test_groups_have_moments_of_their_own(spark):
    df = spark.range(90).selectExpr("id % 3 AS g", "CAST(id AS DOUBLE) AS a", "CAST(id * id AS DOUBLE) AS b").repartition(4)
    got = {(r.g, r.i): r for r in pair_moments(df, ["a", "b"], "g").collect()}
    assert sorted(got) == [(g, i) for g in range(3) for i in range(2)]
    for g in range(3):
        a = np.arange(g, 90, 3.0)
        assert got[g, 0].n == [30.0, 30.0] and np.isclose(got[g, 0].co[1], ((a - a.mean()) * (a * a - (a * a).mean())).sum())
