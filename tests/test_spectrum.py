"""Autocorrelation for all lags against numpy, in one block and over many."""

import numpy as np
import pytest

from stationlab.functions import spectrum
from stationlab.operators import series


def plain(v):
    v = np.asarray(v, float) - np.mean(v)
    return np.correlate(v, v, "full")[len(v) :] / (v @ v)


@pytest.mark.parametrize(("block", "max_lag"), [(4096, None), (8, None), (8, 11), (16, 16), (64, 1)])
def test_all_lags(spark, monkeypatch, block, max_lag):
    monkeypatch.setattr(spectrum, "BLOCK", block)
    monkeypatch.setattr(spectrum, "BAND", 4)
    rng = np.random.default_rng(block)
    data = {"a": rng.normal(1e6, 1, 300), None: rng.normal(size=7), "b": np.arange(90.0) % 12, "two": np.array([1.0, 3.0]), "c": rng.normal(size=150) ** 3}
    rows = [(k, i, float(v)) for k, vs in data.items() for i, v in enumerate(vs)]
    rows += [("a", 1000, None), ("b", 95, float("nan")), ("flat", 1, 0.1), ("flat", 2, 0.1), ("flat", 3, 0.1), ("one", 1, 5.0)]
    df = spark.createDataFrame(rows, "k string, t int, v double").repartition(5)
    got = {}
    for r in series.autocorrelation(df, ["k"], "t", "v", max_lag).collect():
        assert got.setdefault((r.k, r.lag), r.autocorrelation) == r.autocorrelation
    want = {(k, h + 1): x for k, vs in data.items() for h, x in enumerate(plain(vs)) if max_lag is None or h < max_lag}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_one_series_without_keys(spark, monkeypatch):
    monkeypatch.setattr(spectrum, "BLOCK", 32)
    v = np.random.default_rng(1).normal(size=200)
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(v)], "t int, v double")
    got = sorted(tuple(r) for r in series.autocorrelation(df, [], "t", "v").collect())
    assert [h for h, _ in got] == list(range(1, 200)) and np.allclose([x for _, x in got], plain(v), atol=1e-12)
    assert series.autocorrelation(df.limit(0), [], "t", "v").collect() == []
    assert series.autocorrelation(df.limit(0), [], "t", "v", 3).collect() == []
