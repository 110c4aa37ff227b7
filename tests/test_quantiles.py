"""Exact quantiles against numpy, with ties, skew and odd values."""

import numpy as np
import pytest

from stationlab.functions import quantiles as Q

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def shapes():
    rng = np.random.default_rng(3)
    return {
        "normal": rng.normal(size=400),
        "third_equal": np.r_[np.full(200, 7.25), rng.uniform(-5, 50, 400)],
        "outlier": np.r_[rng.uniform(0, 1, 300), [1e15, -1e12]],
        "heavy": np.exp(rng.normal(0, 6, 500)),
        "one": np.array([42.0]),
        "flat": np.full(50, -3.5),
    }


@pytest.fixture(scope="module")
def data(spark):
    rows = [(k, float(v), float(-v)) for k, vs in shapes().items() for v in vs]
    rows += [("normal", None, None), ("normal", float("nan"), None), ("empty", None, None)]
    return spark.createDataFrame(rows, "k string, a double, b double").repartition(7)


@pytest.mark.parametrize("kind", ["cont", "disc"])
def test_grouped(data, kind):
    got = {(r.k, r.column, r.prob): r.value for r in Q.exact_quantiles(data, ["a", "b"], PROBS, ["k"], kind).collect()}
    method = "linear" if kind == "cont" else "inverted_cdf"
    for k, vs in shapes().items():
        for c, s in (("a", vs), ("b", -vs)):
            for p in PROBS:
                assert got[k, c, p] == pytest.approx(np.quantile(s, p, method=method), rel=1e-12, abs=1e-12), (k, c, p)
    assert not any(k == "empty" for k, _, _ in got)


def test_whole_table_and_few_buckets(data, monkeypatch):
    monkeypatch.setattr(Q, "BUCKETS", 4)
    want = np.concatenate(list(shapes().values()))
    for r in Q.exact_quantiles(data, ["a"], PROBS).collect():
        assert r.value == pytest.approx(np.quantile(want, r.prob), rel=1e-12)


def test_approximate(data):
    want = np.sort(np.concatenate(list(shapes().values())))
    for r in Q.approx_quantiles(data, ["a"], [0.25, 0.75], relative_error=0.01).collect():
        lo, hi = np.searchsorted(want, r.value, "left"), np.searchsorted(want, r.value, "right")
        assert lo - 0.02 * len(want) <= r.prob * len(want) <= hi + 0.02 * len(want)


def test_infinities_and_heavy_tails(spark):
    inf = float("inf")
    df = spark.createDataFrame([(x,) for x in [1.0, 2.0, 3.0, 4.0, inf, inf, inf, inf, inf]], "a double")
    assert [r.value for r in Q.exact_quantiles(df, ["a"], [0.7]).collect()] == [inf]
    tails = np.exp(np.random.default_rng(5).normal(0, 40, 20_000)) * np.random.default_rng(6).choice([-1, 1], 20_000)
    df = spark.createDataFrame([(float(x),) for x in tails], "a double")
    for r in Q.exact_quantiles(df, ["a"], PROBS, kind="disc").collect():
        assert r.value == np.quantile(tails, r.prob, method="inverted_cdf")


@pytest.mark.parametrize(("margin", "values"), [(0.0075, 1_000_000), (0.0075, 3), (2e-4, 1_000_000)])
def test_brackets_that_hold_are_wide_or_miss(spark, monkeypatch, margin, values):
    """Ranks found by sorting a bracket, by narrowing one, and after a sketch that is wrong give the same."""
    monkeypatch.setattr(Q, "MARGIN", margin)
    monkeypatch.setattr(Q, "SORTED", values)
    monkeypatch.setattr(Q, "SKETCH", 8 if margin < 1e-3 else 2000)
    rng = np.random.default_rng(9)
    data = {"a": rng.normal(size=30_000), None: np.round(rng.normal(size=9_000), 1), "c": np.full(5_000, 2.0)}
    df = spark.createDataFrame([(k, float(v)) for k, vs in data.items() for v in vs], "k string, a double").repartition(5)
    narrowed = []
    plain = Q._narrowed
    monkeypatch.setattr(Q, "_narrowed", lambda *a: narrowed.append(1) or plain(*a))
    probs = [0.0, 0.003, 0.25, 0.5, 0.999, 1.0]
    got = {(r.k, r.prob): r.value for r in Q.exact_quantiles(df, ["a"], probs, ["k"]).collect()}
    assert len(got) == 18 and all(got[k, p] == pytest.approx(np.quantile(vs, p), rel=1e-12, abs=1e-12) for k, vs in data.items() for p in probs)
    assert bool(narrowed) == (margin < 1e-3 or values == 3)
