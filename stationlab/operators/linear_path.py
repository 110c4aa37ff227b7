"""Cross-validated grids of linear models from one scan.

The folds' means, deviations and co-deviations are all that linear models with squared loss need: those of a training
side are the other folds' merged, every grid point is solved from them on the driver, and the held-out error of a point
follows from its fold's own moments. The data are read once for any number of points; what comes back is one square of
numbers per fold, as wide as there are features.

Points are solved as MLlib's linear regression (normal equations) defines them: features and label by their deviations,
the penalty in these units, the intercept free. Ridge points are closed forms. The others go along falling penalties, each
starting from its neighbour's solution, by coordinate descent until nothing moves.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame

from ..functions.comoments import merged, pair_moments
from ..functions.indexing import bucket_of
from . import evaluate as E
from .prepare import Prepared
from .tuning import FOLDS, LINEAR_GRID

SWEEPS, STILL = 10_000, 1e-13


def fold_moments(df: DataFrame, names: Sequence[str], fold_keys: Sequence[str], folds: int) -> list[list[np.ndarray]]:
    """Per fold the six squares of moments of ``names``, over rows where all are present. Folds go by key hash."""
    whole = df.select(*names, bucket_of(fold_keys, folds).cast("int").alias("_fold")).dropna(subset=list(names))
    p = len(names)
    out = [[np.zeros((p, p)) for _ in range(6)] for _ in range(folds)]
    for r in pair_moments(whole, names, "_fold").collect():
        for k, part in enumerate((r.n, r.mean, r.other_mean, r.dev, r.other_dev, r.co)):
            out[r.g][k][r.i] = part
    return out


def _descend(gram: np.ndarray, target: np.ndarray, l1: float, l2: float, start: np.ndarray) -> np.ndarray:
    b = start.copy()
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(len(b)):
            if gram[j, j] + l2 <= 0:
                continue
            free = target[j] - gram[j] @ b + gram[j, j] * b[j]
            new = np.sign(free) * max(abs(free) - l1, 0.0) / (gram[j, j] + l2)
            moved, b[j] = max(moved, abs(new - b[j])), new
        if moved < STILL:
            break
    return b


def solve_path(moments: Sequence[np.ndarray], regs: Sequence[float], mixes: Sequence[float]) -> dict[tuple[float, float], tuple[np.ndarray, float]]:
    """Coefficients and intercept by (penalty, share of the absolute part). The label is the last column."""
    n, mean, _, _, _, co = moments
    rows = n[0, 0]
    cov = co / rows
    sd = np.sqrt(np.diag(cov))
    used = sd[:-1] > 0
    scale = np.where(sd > 0, sd, 1.0)
    unit = cov / scale[:, None] / scale[None, :]
    gram, target = unit[:-1, :-1], unit[:-1, -1]
    centre = np.diag(mean)
    out = {}
    for mix in mixes:
        b = np.zeros(len(target))
        for reg in sorted(regs, reverse=True):
            l1, l2 = reg / scale[-1] * mix, reg / scale[-1] * (1 - mix)
            if l1 == 0:
                b = np.zeros(len(target))
                b[used] = np.linalg.lstsq(gram[np.ix_(used, used)] + l2 * np.eye(used.sum()), target[used], rcond=None)[0]
            else:
                b = _descend(gram, target, l1, l2, b)
            slope = b * scale[-1] / scale[:-1] * used
            out[reg, mix] = slope, float(centre[-1] - slope @ centre[:-1])
    return out


def squared_error(moments: Sequence[np.ndarray], slope: np.ndarray, intercept: float) -> float:
    """Mean squared error over the rows of the moments."""
    n, mean, _, _, _, co = moments
    w = np.r_[-slope, 1.0]
    centre = np.diag(mean)
    return float(w @ (co / n[0, 0]) @ w + (w @ centre - intercept) ** 2)


def tune_linear(
    p: Prepared,
    fold_keys: Sequence[str],
    regs: Sequence[float] = LINEAR_GRID["regParam"],
    mixes: Sequence[float] = LINEAR_GRID["elasticNetParam"],
    folds: int = FOLDS,
) -> E.ModelResult:
    """Cross-validated grid of linear regressions; the best point is fitted on the whole training side.

    ``details["scores"]`` holds (regParam, elasticNetParam, mean rmse over the folds). Folds without rows are left out.
    """
    names = [*p.feature_cols, p.label_col]
    parts = [m for m in fold_moments(p.train, names, fold_keys, folds) if m[0][0, 0] > 0]
    if len(parts) < 2:
        raise ValueError("two folds with rows needed")
    errors = {point: [] for point in product(regs, mixes)}
    for k, held_out in enumerate(parts):
        rest = [m for j, m in enumerate(parts) if j != k]
        train = rest[0]
        for m in rest[1:]:
            train = merged(train, m)
        for point, (slope, intercept) in solve_path(train, regs, mixes).items():
            errors[point].append(np.sqrt(max(squared_error(held_out, slope, intercept), 0.0)))
    scores = [(reg, mix, float(np.mean(e))) for (reg, mix), e in errors.items()]
    reg, mix, _ = min(scores, key=lambda s: s[2])
    model = LinearRegression(featuresCol=p.features_col, labelCol=p.label_col, regParam=reg, elasticNetParam=mix, maxIter=100).fit(p.train)
    predictions = model.transform(p.test)
    metrics = E.regression_metrics(predictions, p.label_col).first().asDict()
    return E.ModelResult(model, predictions, metrics, {"scores": scores})


def path_report(result: E.ModelResult) -> DataFrame:
    """(regParam, elasticNetParam, score, is_best) for every point."""
    scores = result.details["scores"]
    best = min(scores, key=lambda s: s[2])  # the first of equals, as in the fit
    rows = [(float(r), float(m), s, (r, m, s) == best) for r, m, s in scores]
    return result.predictions.sparkSession.createDataFrame(rows, "regParam double, elasticNetParam double, score double, is_best boolean")
