"""Calendar, lag, rolling and category features."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import cut as C
from ..functions.columns import attach_row, present
from ..functions.indexing import dense_index
from ..functions.naming import station_columns
from ..functions.quantiles import exact_quantiles, approx_quantiles, quantile_row
from ..functions.scale import durable
from ..functions.windows import over_rows

# Feature horizons and thresholds.
LAG_METRICS = ("temp_mean", "humidity", "pressure")
LAGS = (1, 2, 3)
ROLLING_YEARS = (5, 10)
TREND_THRESHOLD = 0.1
TREND_LABELS = ("warming", "cooling", "stable")
CHANGE_TREND_THRESHOLD = 0.2
CHANGE_TREND_LABELS = ("Increasing", "Decreasing", "Stable")
INTERACTION_BASE_YEAR = 1700


# -- calendar -----------------------------------------------------------------------------


def calendar_features(df: DataFrame, time_col: str) -> DataFrame:
    """Year, month, day, day of week (1 = Sunday), month and day names; the hour for timestamps."""
    c = F.col(time_col)
    new = {
        "year": F.year(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "dayofweek": F.dayofweek(c),
        "month_name": F.date_format(c, "MMMM"),
        "day_name": F.date_format(c, "EEEE"),
    }
    if isinstance(df.schema[time_col].dataType, (T.TimestampType, T.TimestampNTZType)):
        new["hour"] = F.hour(c)
    return df.withColumns(new)


def cyclical_encoding(df: DataFrame, month: Column, dayofweek: Column) -> DataFrame:
    """Month and day of week as points on a circle."""
    m, d = month * F.lit(2.0 * math.pi / 12), dayofweek * F.lit(2.0 * math.pi / 7)
    return df.withColumns(
        {"month_sin": F.sin(m), "month_cos": F.cos(m), "dayofweek_sin": F.sin(d), "dayofweek_cos": F.cos(d)}
    )


def season(month: Column, names: Sequence[str] = ("spring", "summer", "fall", "winter")) -> Column:
    """Season of a month number; anything else, NULL included, is the last name."""
    return (
        F.when(month.between(3, 5), names[0])
        .when(month.between(6, 8), names[1])
        .when(month.between(9, 11), names[2])
        .otherwise(names[3])
    )


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


# -- station columns ----------------------------------------------------------------------


def _by_station(df: DataFrame) -> dict[str, dict[str, str]]:
    out: dict[str, dict[str, str]] = {}
    for c, (s, m) in station_columns(df.columns).items():
        out.setdefault(s, {})[m] = c
    return dict(sorted(out.items()))


def temp_swing(df: DataFrame) -> DataFrame:
    """``<station>_temp_swing`` = max - min for every station with both columns."""
    new = {
        f"{s}_temp_swing": F.col(m["temp_max"]) - F.col(m["temp_min"])
        for s, m in _by_station(df).items()
        if "temp_max" in m and "temp_min" in m
    }
    return df.withColumns(new) if new else df


def interaction_terms(df: DataFrame, pairs: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Products of column pairs; by default temperature x humidity per station."""
    if pairs is None:
        pairs = {
            f"{s}_temp_humidity_interaction": (m["temp_mean"], m["humidity"])
            for s, m in _by_station(df).items()
            if "temp_mean" in m and "humidity" in m
        }
    return df.withColumns({n: F.col(a) * F.col(b) for n, (a, b) in pairs.items()}) if pairs else df


def rain_flag(df: DataFrame, suffix: str = "has_rain") -> DataFrame:
    """``<station>_has_rain``: 1 when precipitation is positive, else 0 (NULL counts as dry)."""
    new = {
        f"{s}_{suffix}": F.when(F.col(m["precipitation"]) > 0, 1).otherwise(0)
        for s, m in _by_station(df).items()
        if "precipitation" in m
    }
    return df.withColumns(new) if new else df


def lag_features(
    df: DataFrame,
    time_col: str,
    columns: Sequence[str],
    lags: Sequence[int] = LAGS,
    keys: Sequence[str] = (),
    chunk: int | None = None,
) -> DataFrame:
    """``<column>_lag<k>``: the value k rows earlier in the series (rows, not calendar steps).

    Works on the long form (``keys`` name the series) and on the wide form (no keys: the table is
    one series, cut into chunks of time).
    """

    def stage(w):
        return {f"{c}_lag{k}": F.lag(c, k).over(w) for c in columns for k in lags}

    return over_rows(df, keys, time_col, [stage], before=max(lags), chunk=chunk)


def lead_targets(
    df: DataFrame, time_col: str, names: Mapping[str, str], keys: Sequence[str] = (), chunk: int | None = None
) -> DataFrame:
    """Next-row values as labels: ``names`` maps a column to the label column."""
    return over_rows(
        df, keys, time_col, [lambda w: {n: F.lead(c, 1).over(w) for c, n in names.items()}], after=1, chunk=chunk
    )


# -- buckets ------------------------------------------------------------------------------


def bucket_edges(df: DataFrame, column: str, buckets: int = 5, exact: bool = False, relative_error: float = 0.001) -> DataFrame:
    """The inner edges of equally filled buckets, equal ones merged, as a one-row table ``edges``."""
    probs = [i / buckets for i in range(1, buckets)]
    q = exact_quantiles(df, [column], probs) if exact else approx_quantiles(df, [column], probs, relative_error=relative_error)
    return quantile_row(q, [column], probs).select(
        F.array_sort(F.array_distinct(F.array(*[f"q__0__{j}" for j in range(len(probs))]))).alias("edges")
    )


def assign_bucket(df: DataFrame, column: str, edges: DataFrame, out: str) -> DataFrame:
    """Number of edges at or below the value (left-closed); rows without a value are dropped."""
    x = present(df, column)
    d = attach_row(df.filter(x.isNotNull()), edges, "_s")
    return d.select(*df.columns, F.size(F.filter(F.col("_s.edges"), lambda e: e <= x)).cast("double").alias(out))


def assign_buckets(df: DataFrame, source: DataFrame, columns: Mapping[str, str], buckets: int = 5, exact: bool = False, relative_error: float = 0.001) -> DataFrame:
    """Quantile buckets of several columns (column to new name), edges from ``source``; no row is dropped, NULL has no bucket."""
    cols, probs = list(columns), [i / buckets for i in range(1, buckets)]
    if not cols:
        return df
    q = exact_quantiles(source, cols, probs) if exact else approx_quantiles(source, cols, probs, relative_error=relative_error)
    row = quantile_row(q, cols, probs)
    edges = row.select(*[F.array_sort(F.array_distinct(F.array(*[f"q__{i}__{j}" for j in range(len(probs))]))).alias(f"e{i}") for i in range(len(cols))])
    d = attach_row(df, edges, "_s")

    def bucket(i: int, x: Column) -> Column:
        return F.when(x.isNotNull(), F.size(F.filter(F.col(f"_s.e{i}"), lambda e: e <= x)).cast("double"))

    return d.select(*df.columns, *[bucket(i, present(df, c)).alias(columns[c]) for i, c in enumerate(cols)])


def quantile_bucket(
    df: DataFrame, column: str, out: str | None = None, buckets: int = 5, exact: bool = False, relative_error: float = 0.001
) -> DataFrame:
    """Index of the quantile bucket of each row."""
    return assign_bucket(df, column, bucket_edges(df, column, buckets, exact, relative_error), out or f"{column}_bucket")


def fixed_bucket(df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str], out: str | None = None, right: bool = True) -> DataFrame:
    """Labelled bins from given edges."""
    return df.withColumn(out or f"{column}_category", C.cut(F.col(column), edges, labels, right))


def sql_transform(df: DataFrame, statement: str) -> DataFrame:
    """Apply a SQL statement over ``__THIS__``."""
    return SQLTransformer(statement=statement).transform(df)


# -- city series --------------------------------------------------------------------------


def rolling_mean_prior(
    df: DataFrame,
    keys: Sequence[str],
    time_col: str,
    column: str,
    sizes: Sequence[int] = ROLLING_YEARS,
    name: str = "avg_temp_last_{n}years",
    diff: str | None = None,
    chunk: int | None = None,
) -> DataFrame:
    """Mean over the ``n`` rows before the current one; with ``diff`` also value minus that mean."""

    def means(w):
        return {name.format(n=n): F.avg(column).over(w.rowsBetween(-n, -1)) for n in sizes}

    out = over_rows(df, keys, time_col, [means], before=max(sizes), chunk=chunk)
    if diff:
        out = out.withColumns({diff.format(n=n): F.col(column) - F.col(name.format(n=n)) for n in sizes})
    return out


def diff_from_rolling(df: DataFrame, keys: Sequence[str], time_col: str, column: str, sizes: Sequence[int] = ROLLING_YEARS, chunk: int | None = None) -> DataFrame:
    """Rolling prior means and the distance from each."""
    return rolling_mean_prior(df, keys, time_col, column, sizes, diff="diff_from_{n}yr_avg", chunk=chunk)


def _change(column: str):
    def stage(w):
        prev = F.lag(column, 1).over(w)
        return {"prev_year_temp": prev, "yoy_change": F.col(column) - prev}

    return stage


def _second(w):
    prev = F.lag("yoy_change", 1).over(w)
    return {"prev_yoy_change": prev, "temp_acceleration": F.col("yoy_change") - prev}


def yoy_change(df: DataFrame, keys: Sequence[str], time_col: str, column: str, chunk: int | None = None) -> DataFrame:
    """Previous value and change from it."""
    return over_rows(df, keys, time_col, [_change(column)], before=1, chunk=chunk)


def acceleration(df: DataFrame, keys: Sequence[str], time_col: str, column: str, chunk: int | None = None) -> DataFrame:
    """Change of the change."""
    return over_rows(df, keys, time_col, [_change(column), _second], before=2, chunk=chunk)


def trend_label(change: Column, threshold: float = TREND_THRESHOLD, labels: Sequence[str] = TREND_LABELS) -> Column:
    return C.sign_label(change, threshold, labels)


def temp_regime(value: Column) -> Column:
    return C.ladder(value, *C.REGIME_LADDER)


def global_deviation(df: DataFrame, time_col: str, column: str) -> DataFrame:
    """Mean over all rows of the same time value, and the distance from it.

    The means are one row per time value. They are stored first, so the join is a broadcast exactly
    when the stored table is small. Rows without a time value get NULL.
    """
    means = durable(df.groupBy(time_col).agg(F.avg(column).alias("global_avg_temp")).filter(F.col(time_col).isNotNull()))
    out = df.join(means, time_col, "left")
    return out.select(*df.columns, "global_avg_temp", (F.col(column) - F.col("global_avg_temp")).alias("deviation_from_global_avg"))


def city_index(df: DataFrame, column: str = "City", out: str = "city_index") -> DataFrame:
    """Dense index of the value in sort order (0-based); NULL becomes 0."""
    ids = dense_index(df, [column], "_id")
    joined = df.join(ids, column, "left")
    return joined.select(*df.columns, F.coalesce(F.col("_id"), F.lit(0)).cast("double").alias(out))


def city_year_interaction(df: DataFrame, index: str = "city_index", year: str = "Year") -> DataFrame:
    return df.withColumn("city_year_interaction", F.col(index) * (F.col(year) - INTERACTION_BASE_YEAR))


def temperature_series(df: DataFrame, keys: Sequence[str], time_col: str, column: str, chunk: int | None = None) -> DataFrame:
    """Rolling means, distances, changes and acceleration with one shared window sort."""

    def means(w):
        return {f"avg_temp_last_{n}years": F.avg(column).over(w.rowsBetween(-n, -1)) for n in ROLLING_YEARS}

    def change(w):
        diffs = {f"diff_from_{n}yr_avg": F.col(column) - F.col(f"avg_temp_last_{n}years") for n in ROLLING_YEARS}
        return {**_change(column)(w), **diffs}

    return over_rows(df, keys, time_col, [means, change, _second], before=max(ROLLING_YEARS), chunk=chunk)
