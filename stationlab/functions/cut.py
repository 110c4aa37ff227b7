"""Interval and category columns from edge lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

INF = float("inf")

# Category edges and labels.
TEMP_BINS = ((-100, 0, 10, 20, 30, 100), ("Freezing", "Cold", "Mild", "Warm", "Hot"))
PRECIP_BINS = ((-1, 0, 1, 5, 10, 1000), ("None", "Light", "Moderate", "Heavy", "Extreme"))
CHANGE_BINS = (
    (-100, -1, -0.2, 0.2, 1, 100),
    ("Significant cooling", "Cooling", "Stable", "Warming", "Significant warming"),
)
TEMP_LADDER = ((0, 5, 10, 15, 20, 25), ("freezing", "very_cold", "cold", "mild", "warm", "hot", "very_hot"))
HUMIDITY_LADDER = ((0.3, 0.5, 0.7, 0.8), ("very_dry", "dry", "moderate", "humid", "very_humid"))
CHANGE_LADDER = ((-1, -0.2, 0.2, 1), ("significant_cooling", "cooling", "stable", "warming", "significant_warming"))
REGIME_LADDER = ((0, 10, 20, 25), ("freezing", "cold", "moderate", "warm", "hot"))


def cut(value: Column, edges: Sequence[float], labels: Sequence[str], right: bool = True) -> Column:
    """Labelled bins; a value outside all bins (or NULL, NaN) gives NULL.

    ``right=True``: bins ``(a, b]``. ``right=False``: bins ``[a, b)``, the last one closed.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("one label per bin")
    out = F.when(value.isNull() | F.isnan(value), F.lit(None).cast("string"))
    last = len(labels) - 1
    for i, label in enumerate(labels):
        lo, hi = F.lit(float(edges[i])), F.lit(float(edges[i + 1]))
        if right:
            inside = (value > lo) & (value <= hi)
        else:
            inside = (value >= lo) & ((value <= hi) if i == last else (value < hi))
        out = out.when(inside, F.lit(label))
    return out


def ladder(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """First label whose edge exceeds the value; the last label takes the rest, NULL included."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than edges")
    out = None
    for edge, label in zip(edges, labels):
        test = value < F.lit(float(edge))
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def sign_label(value: Column, threshold: float, labels: Sequence[str]) -> Column:
    """``labels`` = (above, below, else); NULL takes the last one."""
    up, down, rest = labels
    return F.when(value > threshold, up).when(value < -threshold, down).otherwise(rest)
