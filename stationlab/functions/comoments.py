"""Means, squared deviations and co-deviations of all pairs of columns, each over the rows where both are present.

A task turns its rows into blocks of a matrix and a mask of what is present; products of these give the sums of all pairs
at once. What leaves a task is one row per column with arrays over the other columns, however many rows it read. Partial
moments are merged per column, each pair by the difference of the partial means, so nothing cancels.

Sums are taken about a value of the task's own rows; a column without spread has exactly zero deviations. A column that
holds an infinity has NaN deviations.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame

from .columns import value_sql

# executors need numpy and pyarrow, but not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Per column i and other column k: rows with both, means of i and of k, squared deviations of both, co-deviation.
PARTS = ("n", "mean", "other_mean", "dev", "other_dev", "co")
MOMENTS = "g int, i int, " + ", ".join(f"{c} array<double>" for c in PARTS)


def _rows(group: int, first: int, moments: Sequence[np.ndarray]) -> pa.RecordBatch:
    p, width = moments[0].shape
    offsets = pa.array(np.arange(p + 1, dtype=np.int32) * width)
    lists = [pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(m).reshape(-1))) for m in moments]
    keys = [pa.array(np.full(p, group, np.int32)), pa.array(np.arange(first, first + p, dtype=np.int32))]
    return pa.RecordBatch.from_arrays([*keys, *lists], ["g", "i", *PARTS])


class _Sums:
    """Sums of one group of rows, of ``p`` columns, about a value of their own."""

    def __init__(self, p: int):
        self.shift, self.known, self.infinite = np.zeros(p), np.zeros(p, bool), np.zeros(p, bool)
        self.n, self.sums, self.squares, self.products = (np.zeros((p, p)) for _ in range(4))

    def add(self, x: np.ndarray) -> None:
        self.infinite |= np.isinf(x).any(axis=1)
        there = np.isfinite(x)
        for k in np.flatnonzero(~self.known & there.any(axis=1)):
            own = x[k, there[k]]
            self.shift[k], self.known[k] = np.partition(own, len(own) // 2)[len(own) // 2], True
        x = np.where(there, x - self.shift[:, None], 0.0)
        mask = there.astype(float)
        self.n += mask @ mask.T
        self.sums += x @ mask.T
        self.squares += (x * x) @ mask.T
        self.products += x @ x.T

    def moments(self) -> list[np.ndarray]:
        at = np.maximum(self.n, 1)
        dev = np.maximum(self.squares - self.sums * self.sums / at, 0)
        co = self.products - self.sums * self.sums.T / at
        dev[self.infinite], co[self.infinite], co[:, self.infinite] = np.nan, np.nan, np.nan
        return [self.n, self.sums / at + self.shift[:, None], self.sums.T / at + self.shift[None, :], dev, dev.T, co]


def _partial(p: int):
    """Rows of a group number and ``p`` double columns to the moments of one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Sums] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            group, *cells = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            x = np.stack(cells).astype(float)
            for g in np.unique(group):
                held.setdefault(int(g), _Sums(p)).add(x[:, group == g])
        for g, sums in held.items():
            yield _rows(g, 0, sums.moments())

    return run


def merged(held: Sequence[np.ndarray], more: Sequence[np.ndarray]) -> list[np.ndarray]:
    """The moments of two sets of rows together."""
    n, a, b, da, db, co = held
    m, c, d, dc, dd, cp = more
    total = np.maximum(n + m, 1)
    u, v, w = c - a, d - b, n * m / total
    return [n + m, np.where(n > 0, a + u * m / total, c), np.where(n > 0, b + v * m / total, d), da + dc + u * u * w, db + dd + v * v * w, co + cp + u * v * w]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Moments sorted by g and i to one row for both."""
    now, held = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        parts = [c.flatten().to_numpy().reshape(len(keys), -1) for c in batch.columns[2:]]
        for r, key in enumerate(keys):
            row = [x[r] for x in parts]
            if key != now:
                if held is not None:
                    yield _rows(*now, [x[None] for x in held])
                now, held = key, row
            else:
                held = merged(held, row)
    if held is not None:
        yield _rows(*now, [x[None] for x in held])


def pair_moments(df: DataFrame, names: Sequence[str], group: str = "0") -> DataFrame:
    """``(g, i, n, mean, other_mean, dev, other_dev, co)``: one row per column of ``names``, arrays over all columns.

    ``group`` is an expression for a small whole number; each has moments of its own. One scan. A shuffle carries
    one row per group, column and task; columns are merged in parallel.
    """
    cells = df.selectExpr(f"CAST({group} AS INT) AS g", *[f"{value_sql(df, c)} AS c{k}" for k, c in enumerate(names)])
    partial = cells.mapInArrow(_partial(len(names)), MOMENTS)
    return partial.repartition("g", "i").sortWithinPartitions("g", "i").mapInArrow(_merge, MOMENTS)
