"""Sums of lagged products of series of any length, for all lags, by blocked Fourier transforms.

Rows are numbered, and a stretch of ``BLOCK`` numbers is a block. A series inside one block gets its products from the power
spectrum of its own padded values. A longer one takes three steps, each spread by a shuffle:

1. each block is transformed, and its spectrum leaves in bands of frequencies;
2. per (series, band) the blocks' values are correlated along the blocks, again by a transform: the cross spectrum of all
   pairs of blocks that are d blocks apart;
3. per (series, d) the bands meet and are transformed back, which gives the lags around d blocks; lags between two
   distances get a part from both (overlap-add).

That is n log n steps for all n lags; a task holds one block, or one band of a series' blocks, never a series. Products
carry the rounding of a transform, some 1e-16 of the lag 0 sum.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

# executors need numpy and pyarrow, but not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a block (a power of two), and frequencies that travel together.
BLOCK, BAND = 4096, 16
PRODUCTS = "start long, lag long, product double"
BANDS = "start long, block long, band int, re array<double>, im array<double>"


def _groups(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[list[np.ndarray | pa.Array]]:
    """Columns of whole groups (runs of equal first ``by`` columns), several groups at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        keys = [np.asarray(batch.column(k)) for k in range(by)]
        same = np.logical_and.reduce([k == k[-1] for k in keys])
        cut = batch.num_rows - int(same.sum())  # the last group may go on
        if cut or any(held[0].column(k)[0] != batch.column(k)[0] for k in range(by)):
            held[-1] = batch.slice(0, cut)
            yield [c.combine_chunks() for c in pa.Table.from_batches(held).columns]
            held = [batch.slice(cut)]
    if held:
        yield [c.combine_chunks() for c in pa.Table.from_batches(held).columns]


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a group begins, and the end."""
    new = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.r_[0, np.flatnonzero(new) + 1, len(keys[0])]


def _products(start: np.ndarray, lag: np.ndarray, product: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(start), pa.array(lag.astype(np.int64)), pa.array(product)], ["start", "lag", "product"])


def _whole(max_lag: int | None):
    """Rows (start, v) of series that lie in one block each to their products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _groups(batches, 1):
            start, v = (c.to_numpy() for c in columns)
            edge = _starts(start)
            sizes = np.diff(edge)
            width = 2 << np.ceil(np.log2(sizes)).astype(int)
            for w in np.unique(width):
                here = np.flatnonzero(width == w)
                n = sizes[here]
                row, col = np.repeat(np.arange(len(here)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                padded = np.zeros((len(here), w))
                padded[row, col] = v[edge[here][row] + col]
                out = np.fft.irfft(np.abs(np.fft.rfft(padded)) ** 2, w)
                told = (col > 0) & (col <= (max_lag or w))
                yield _products(start[edge[here]][row[told]], col[told], out[row[told], col[told]])

    return run


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (start, block, at, v) to the bands of each block's spectrum."""
    bands = -(-(BLOCK + 1) // BAND)
    for columns in _groups(batches, 2):
        start, block, at, v = (c.to_numpy() for c in columns)
        edge = _starts(start, block)
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            padded = np.zeros(2 * BLOCK)
            padded[at[a:b]] = v[a:b]
            yield _banded(start[a], block[a], np.fft.rfft(padded), bands)


def _banded(start, block, spectrum: np.ndarray, bands: int) -> pa.RecordBatch:
    full = np.zeros(bands * BAND, complex)
    full[: len(spectrum)] = spectrum
    offsets = pa.array(np.arange(bands + 1, dtype=np.int32) * BAND)
    parts = [pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(x))) for x in (full.real, full.imag)]
    keys = [pa.array(np.full(bands, start)), pa.array(np.full(bands, block)), pa.array(np.arange(bands, dtype=np.int32))]
    return pa.RecordBatch.from_arrays(keys + parts, ["start", "block", "band", "re", "im"])


def _along(max_lag: int | None):
    """Rows (start, band, block, re, im) in order to the cross spectra by distance of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _groups(batches, 2):
            start, band = (columns[k].to_numpy() for k in (0, 1))
            re, im = (columns[k].flatten().to_numpy().reshape(-1, BAND) for k in (3, 4))
            edge = _starts(start, band)
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                m = b - a
                z = np.fft.fft(re[a:b] + 1j * im[a:b], 2 << int(m - 1).bit_length(), axis=0)
                s = np.fft.ifft(np.abs(z) ** 2, axis=0)[: m if max_lag is None else min(m, max_lag // BLOCK + 2)]
                offsets = pa.array(np.arange(len(s) + 1, dtype=np.int32) * BAND)
                parts = [pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(x).reshape(-1))) for x in (s.real, s.imag)]
                keys = [pa.array(np.full(len(s), start[a])), pa.array(np.arange(len(s))), pa.array(np.full(len(s), band[a], np.int32))]
                yield pa.RecordBatch.from_arrays(keys + parts, ["start", "block", "band", "re", "im"])

    return run


def _back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (start, distance, band, re, im) in order to parts of the products."""
    k = np.arange(1, BLOCK)
    for columns in _groups(batches, 2):
        start, far = (columns[i].to_numpy() for i in (0, 1))
        re, im = (columns[i].flatten().to_numpy().reshape(-1, BAND) for i in (3, 4))
        edge = _starts(start, far)
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            c = np.fft.irfft((re[a:b] + 1j * im[a:b]).reshape(-1)[: BLOCK + 1], 2 * BLOCK)
            d = far[a] * BLOCK
            lag, product = (k, c[k]) if d == 0 else (np.r_[d, d + k, d - k], np.r_[c[0], c[k], c[2 * BLOCK - k]])
            yield _products(np.full(len(lag), start[a]), lag, product)


def lagged_products(rows: DataFrame, max_lag: int | None = None) -> DataFrame:
    """``(start, lag, product)`` for lags 1, 2, ... of every series of the stored ``rows(start, n, row, v)``.

    A series is the ``n`` rows numbered from ``start``; ``v`` is its value less its mean. Lags end with the
    series or with ``max_lag``.
    """
    block = F.expr(f"row div {BLOCK}")
    inside = F.expr(f"start div {BLOCK} = (start + n - 1) div {BLOCK}")
    dealt = rows.filter(inside).select("start", "v", "row", block.alias("block")).repartition("block").sortWithinPartitions("row")
    whole = dealt.select("start", "v").mapInArrow(_whole(max_lag), PRODUCTS)
    if rows.filter(~inside).isEmpty():
        return whole
    blocks = rows.filter(~inside).select("start", block.alias("block"), F.expr(f"row % {BLOCK}").alias("at"), "v")
    spectra = blocks.repartition("start", "block").sortWithinPartitions("start", "block").mapInArrow(_transform, BANDS)
    by_band = spectra.select("start", "band", "block", "re", "im").repartition("start", "band").sortWithinPartitions("start", "band", "block")
    crossed = by_band.mapInArrow(_along(max_lag), BANDS).repartition("start", "block").sortWithinPartitions("start", "block", "band")
    parts = crossed.mapInArrow(_back, PRODUCTS).groupBy("start", "lag").agg(F.sum("product").alias("product"))
    ends = rows.filter(~inside).select("start", "n").distinct()
    full = parts.join(ends, "start").filter((F.col("lag") < F.col("n")) & (F.lit(max_lag).isNull() | (F.col("lag") <= F.lit(max_lag))))
    return whole.union(full.select("start", "lag", "product"))
