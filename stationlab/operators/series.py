"""Time-series views: extraction, rolling statistics, seasonality, autocorrelation, decomposition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import attach_row, present
from ..functions.indexing import number_rows
from ..functions.scale import durable
from ..functions.spectrum import lagged_products
from ..functions.windows import over_rows


def series_extract(df: DataFrame, time_col: str, metric: str, where: Mapping[str, object] | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Filter to the given key values and return (keys, time, metric) in order."""
    out = df
    for c, v in (where or {}).items():
        out = out.filter(F.col(c).isin(*v) if isinstance(v, (list, tuple, set)) else F.col(c) == v)
    return out.select(*keys, time_col, metric).orderBy(*keys, time_col)


def rolling_stats(
    df: DataFrame, keys: Sequence[str], time_col: str, column: str, window: int = 10, chunk: int | None = None
) -> DataFrame:
    """Trailing mean and deviation over ``window`` rows, NULL until all of them have a value."""

    def stage(w):
        frame = w.rowsBetween(-(window - 1), 0)
        v = present(df, column).cast("double")
        full = F.count(v).over(frame) == window
        return {
            "rolling_mean": F.when(full, F.avg(v).over(frame)),
            "rolling_std": F.when(full, F.stddev_samp(v).over(frame)),
        }

    return over_rows(df, keys, time_col, [stage], before=window - 1, chunk=chunk)


def seasonality(df: DataFrame, month: Column, column: str) -> DataFrame:
    """Mean per calendar month with the month's short name."""
    rows = df.select(month.cast("int").alias("month"), present(df, column).cast("double").alias("_v"))
    label = F.date_format(F.make_date(F.lit(2000), F.col("month"), F.lit(1)), "MMM")
    return (
        rows.filter(F.col("month").isNotNull())
        .groupBy("month")
        .agg(F.avg("_v").alias("mean"))
        .select("month", label.alias("month_name"), "mean")
        .orderBy("month")
    )


def autocorrelation(df: DataFrame, keys: Sequence[str], time_col: str, column: str, max_lag: int | None = None) -> DataFrame:
    """r(h) per series for all lags, or those up to ``max_lag``: ``(keys..., lag, autocorrelation)``.

    Missing values are left out, so a lag counts present rows. One range sort numbers the rows; the lagged products
    come from blocked power spectra (``functions/spectrum.py``), in n log n steps, and a series is never held in
    one place. Series without spread have no autocorrelation.
    """
    rows = df.select(*keys, time_col, present(df, column).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = number_rows(rows, [*[F.col(k) for k in keys], F.col(time_col).asc_nulls_first(), F.xxhash64(time_col, "_v")], "_row", parts)
    v = F.col("_v")
    stats = numbered.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.avg(v).alias("_m"), (F.var_pop(v) * F.count("*")).alias("_ss"), F.min("_row").alias("_start")
    )
    stats = durable(stats.filter("_ss > 0"))
    named = stats.select("_n", "_m", "_start", *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.lit(True))
    if keys:
        centred = numbered.join(named, same)
    else:
        centred = attach_row(numbered, named.agg(*[F.max(c).alias(c) for c in ("_n", "_m", "_start")]), "_s").select("*", "_s.*").filter("_n IS NOT NULL")
    centred = centred.select(F.col("_start").alias("start"), F.col("_n").alias("n"), F.col("_row").alias("row"), (v - F.col("_m")).alias("v"))
    products = lagged_products(durable(centred), max_lag)
    told = products.join(stats.withColumnRenamed("_start", "start"), "start")
    return told.select(*keys, F.col("lag").cast("int").alias("lag"), (F.col("product") / F.col("_ss")).alias("autocorrelation"))


def seasonal_decompose(
    df: DataFrame,
    keys: Sequence[str],
    time_col: str,
    column: str,
    phase: Column,
    period: int = 12,
    chunk: int | None = None,
) -> DataFrame:
    """Additive parts ``trend``, ``seasonal`` and ``residual``.

    Trend: centred moving mean over one period (half weight at both ends when the period is even),
    NULL where the frame is not full. Seasonal: mean of value - trend per phase, shifted to sum to
    zero over the phases. Residual: the rest.
    """
    half = period // 2
    v = F.col(column).cast("double")

    def trend(w):
        if period % 2:
            frame = w.rowsBetween(-half, half)
            return {"trend": F.when(F.count(v).over(frame) == period, F.avg(v).over(frame))}
        left, right, whole = w.rowsBetween(-half, half - 1), w.rowsBetween(-half + 1, half), w.rowsBetween(-half, half)
        full = F.count(v).over(whole) == period + 1
        return {"trend": F.when(full, (F.avg(v).over(left) + F.avg(v).over(right)) / 2)}

    out = durable(over_rows(df.withColumn("_phase", phase), keys, time_col, [trend], before=half, after=half, chunk=chunk))
    means = out.groupBy(*keys, "_phase").agg(F.avg(v - F.col("trend")).alias("_m"))
    per_key = means.groupBy(*keys).agg(F.avg("_m").alias("_c"), F.collect_list(F.struct("_phase", "_m")).alias("_ps"))
    seasonal = durable(
        per_key.select(*keys, "_c", F.inline("_ps")).select(*keys, "_phase", (F.col("_m") - F.col("_c")).alias("seasonal"))
    )
    joined = out.join(seasonal, [*keys, "_phase"], "left")
    return joined.select(*df.columns, "trend", "seasonal", (v - F.col("trend") - F.col("seasonal")).alias("residual"))
