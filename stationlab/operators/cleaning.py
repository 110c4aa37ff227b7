"""Missing rows, outliers, imputation and scaling."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import attach_row, column_stats, literal, numeric_columns, present, quoted, require, stat, stats_row, value_sql
from ..functions.quantiles import approx_quantiles, exact_quantiles, quantile_row, quantiles
from ..functions.scale import durable
from ..functions.windows import over_range, position


# -- rows ---------------------------------------------------------------------------------


def drop_sparse_rows(df: DataFrame, max_missing: int = 12) -> DataFrame:
    """Keep rows with at most ``max_missing`` NULL or NaN values."""
    return df.na.drop(thresh=max(len(df.columns) - max_missing, 0))


def drop_missing_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with NULL or NaN in one of the columns."""
    require(df, columns)
    return df.na.drop(subset=list(columns))


def filter_invalid(
    df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]], keep_null: bool = True
) -> DataFrame:
    """Keep rows whose values lie inside the inclusive bounds; ``None`` leaves a side open."""
    require(df, bounds)
    test = None
    for name, (lo, hi) in bounds.items():
        c = F.col(name)
        ok = F.lit(True)
        if lo is not None:
            ok = ok & (c >= lo)
        if hi is not None:
            ok = ok & (c <= hi)
        ok = (ok | c.isNull()) if keep_null else (ok & c.isNotNull())
        test = ok if test is None else test & ok
    return df.filter(test) if test is not None else df


def fill_constant(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace missing values by one constant per column."""
    return df.na.fill(dict(values))


# -- outliers -----------------------------------------------------------------------------


def _targets(df: DataFrame, columns: Sequence[str] | None, id_cols: Iterable[str]) -> list[str]:
    return list(columns or numeric_columns(df, id_cols))


MOMENTS = {"mean": "avg(v)", "sd": "stddev_samp(v)"}


def _with_moments(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return attach_row(df, stats_row(column_stats(df, names, MOMENTS)), "_s")


def _z(df: DataFrame, name: str, i: int) -> str:
    """|z| of a column as SQL text; NULL for NULL values and for columns without spread."""
    return f"abs(({value_sql(df, name)} - {stat(i, 'mean')}) / nullif({stat(i, 'sd')}, 0))"


def _replace(df: DataFrame, new: Mapping[str, str], order: Sequence[str]) -> DataFrame:
    return df.selectExpr(*[f"{new[c]} AS {quoted(c)}" if c in new else quoted(c) for c in order])


def zscore_outliers(
    df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 3.0, id_cols: Sequence[str] = ()
) -> DataFrame:
    """``id_cols`` plus a flag ``<column>_outlier`` = |z| > threshold.

    NULL and columns without spread are never flagged. Rows keep their number and grain.
    """
    names = _targets(df, columns, id_cols)
    d = _with_moments(df, names)
    flags = []
    for i, c in enumerate(names):
        flags.append(f"coalesce({_z(df, c, i)} > {float(threshold)!r}D, false) AS {quoted(c + '_outlier')}")
    return d.selectExpr(*map(quoted, id_cols), *flags)


def iqr_outliers(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    threshold: float = 3.0,
    id_cols: Sequence[str] = (),
    exact: bool = True,
    relative_error: float = 0.01,
) -> DataFrame:
    """As :func:`zscore_outliers` with the fences ``q1 - t*iqr`` and ``q3 + t*iqr``."""
    names = _targets(df, columns, id_cols)
    q = quantiles(df, names, [0.25, 0.75], exact=exact, relative_error=relative_error)
    d = attach_row(df, quantile_row(q, names, [0.25, 0.75]), "_s")
    flags = []
    t = f"{float(threshold)!r}D"
    for i, c in enumerate(names):
        v, q1, q3 = value_sql(df, c), f"_s.q__{i}__0", f"_s.q__{i}__1"
        out = f"{v} < {q1} - {t} * ({q3} - {q1}) OR {v} > {q3} + {t} * ({q3} - {q1})"
        flags.append(f"coalesce({out}, false) AS {quoted(c + '_outlier')}")
    return d.selectExpr(*map(quoted, id_cols), *flags)


def outliers_cap(
    df: DataFrame, columns: Sequence[str] | None = None, z: float = 3.0, id_cols: Sequence[str] = ()
) -> DataFrame:
    """Clip values to mean +/- z deviations; NULL stays NULL."""
    names = _targets(df, columns, id_cols)
    d = _with_moments(df, names)
    new = {}
    for i, c in enumerate(names):
        v, m, reach = f"CAST({quoted(c)} AS DOUBLE)", stat(i, "mean"), f"{float(z)!r}D * {stat(i, 'sd')}"
        hi, lo = f"{m} + {reach}", f"{m} - {reach}"
        new[c] = f"CASE WHEN {value_sql(df, c)} > {hi} THEN {hi} WHEN {v} < {lo} THEN {lo} ELSE {v} END"
    return _replace(d, new, df.columns)


def outliers_to_null(
    df: DataFrame, columns: Sequence[str] | None = None, z: float = 3.0, id_cols: Sequence[str] = ()
) -> DataFrame:
    """Set values farther than z deviations from the mean to NULL."""
    names = _targets(df, columns, id_cols)
    d = _with_moments(df, names)
    new = {}
    for i, c in enumerate(names):
        new[c] = f"CASE WHEN {_z(df, c, i)} > {float(z)!r}D THEN NULL ELSE {quoted(c)} END"
    return _replace(d, new, df.columns)


def outliers_remove(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    z: float = 3.0,
    id_cols: Sequence[str] = (),
    sequential: bool = True,
    keep_nulls: bool = False,
) -> DataFrame:
    """Keep rows within z deviations of the mean in every column.

    ``sequential``: each column's mean and deviation come from the rows the earlier columns left,
    one aggregate per column over the kept input columns; only the two numbers come back to the plan. Otherwise all columns
    use the input's statistics in one pass. A column without spread filters nothing.
    """
    names = _targets(df, columns, id_cols)
    if sequential:
        out, left = df, df.select(*[F.col(f"`{c}`") for c in names]).persist(StorageLevel.MEMORY_AND_DISK)
        read = left
        try:
            for c in names:
                v = value_sql(left, c)
                mean, sd = left.selectExpr(f"avg({v})", f"stddev_samp({v})").first()
                if sd is not None and sd > 0:
                    v = present(df, c)
                    ok = F.abs((v - F.lit(mean)) / F.lit(sd)) <= z
                    keep = ok | v.isNull() if keep_nulls else ok
                    out, left = out.filter(keep), left.filter(keep)
        finally:
            read.unpersist()
        return out
    d = _with_moments(df, names)
    for i, c in enumerate(names):
        # z is NULL for NULL values (dropped, unless kept) and when the column has no spread (kept)
        flat = f"coalesce({stat(i, 'sd')}, 0) = 0"
        null = f" OR {value_sql(df, c)} IS NULL" if keep_nulls else ""
        d = d.filter(f"{flat} OR {_z(df, c, i)} <= {float(z)!r}D{null}")
    return d.select(*df.columns)


# -- imputation ---------------------------------------------------------------------------


def _impute_from(df: DataFrame, names: Sequence[str], fills: DataFrame) -> DataFrame:
    """Fill from rows (i, fill), one per named column."""
    d = attach_row(df, fills.agg(F.map_from_entries(F.collect_list(F.struct("i", "fill"))).alias("fill")), "_s")
    new = {c: f"coalesce({value_sql(df, c)}, try_element_at(_s.fill, {i}))" for i, c in enumerate(names)}
    return _replace(d, new, df.columns)


def impute_mean(df: DataFrame, columns: Sequence[str] | None = None, id_cols: Sequence[str] = ()) -> DataFrame:
    names = _targets(df, columns, id_cols)
    return _impute_from(df, names, column_stats(df, names, {"fill": "avg(v)"}))


def impute_median(
    df: DataFrame, columns: Sequence[str] | None = None, id_cols: Sequence[str] = (), exact: bool = False
) -> DataFrame:
    """Fill with the median that is a value of the column; a sketch (0.1 % rank error) unless ``exact``."""
    names = _targets(df, columns, id_cols)
    if exact:
        q = exact_quantiles(df, names, [0.5], kind="disc")
    else:
        q = approx_quantiles(df, names, [0.5], relative_error=0.001)
    at = "array_position(array(" + ", ".join(map(literal, names)) + "), column) - 1"
    return _impute_from(df, names, q.selectExpr(f"CAST({at} AS INT) AS i", "value AS fill"))


def impute_mode(df: DataFrame, columns: Sequence[str] | None = None, id_cols: Sequence[str] = ()) -> DataFrame:
    """Fill with the most frequent value, the smallest one on ties."""
    names = _targets(df, columns, id_cols)
    counts = (
        df.selectExpr(f"posexplode(array({', '.join(value_sql(df, c) for c in names)})) AS (i, v)")
        .filter("v IS NOT NULL")
        .groupBy("i", "v")
        .agg(F.count("*").alias("n"))
    )
    return _impute_from(df, names, counts.groupBy("i").agg(F.expr("max_by(v, struct(n, -v)) AS fill")))


IMPUTERS = {"mean": impute_mean, "median": impute_median, "mode": impute_mode}


def clean_dataset(
    df: DataFrame,
    id_cols: Sequence[str] = (),
    impute_method: str = "mean",
    outlier_handling: str = "remove",
    z_threshold: float = 3.0,
    order: str = "outliers_first",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Treat outliers (``remove``, ``cap``, ``impute`` or ``keep``), then fill what is missing.

    ``order="impute_first"`` fills first and takes the outlier statistics from the filled columns.
    """
    names = _targets(df, columns, id_cols)
    if impute_method not in IMPUTERS:
        raise ValueError(f"impute_method must be one of {sorted(IMPUTERS)}")
    if outlier_handling not in ("remove", "cap", "impute", "keep"):
        raise ValueError(f"unknown outlier_handling {outlier_handling!r}")

    def outliers(d: DataFrame) -> DataFrame:
        if outlier_handling == "remove":
            return outliers_remove(d, names, z_threshold)
        if outlier_handling == "cap":
            return outliers_cap(d, names, z_threshold)
        if outlier_handling == "impute":
            return outliers_to_null(d, names, z_threshold)
        return d

    fill = IMPUTERS[impute_method]
    if order == "impute_first":
        return outliers(fill(df, names))
    return fill(outliers(df), names)


# -- scaling and moving windows -----------------------------------------------------------


def standardize(df: DataFrame, columns: Sequence[str] | None = None, id_cols: Sequence[str] = ()) -> DataFrame:
    """Add vectors ``features`` and ``scaledFeatures`` (zero mean, unit sample deviation).

    Rows with a missing value are dropped; a column without spread becomes 0.
    """
    names = _targets(df, columns, id_cols)
    stages = [
        VectorAssembler(inputCols=names, outputCol="features", handleInvalid="skip"),
        StandardScaler(inputCol="features", outputCol="scaledFeatures", withMean=True, withStd=True),
    ]
    return Pipeline(stages=stages).fit(df).transform(df)


def scaled_columns(df: DataFrame, names: Sequence[str], vector: str = "scaledFeatures") -> DataFrame:
    """Spread a vector column into ``<name>_scaled`` columns."""
    a = vector_to_array(F.col(vector))
    return df.withColumns({f"{n}_scaled": a[i] for i, n in enumerate(names)})


def moving_anomalies(
    df: DataFrame,
    keys: Sequence[str],
    time_col: str,
    columns: Sequence[str],
    window_size: int = 5,
    threshold: float = 2.0,
    chunk: int | None = None,
) -> DataFrame:
    """Flag values more than ``threshold`` deviations from the mean of the +/- ``window_size`` range.

    The range counts days for dates and units for numbers. Adds ``<column>_anomaly``.

    Rows of one moment have one frame, so they become one row of moments first (count, mean, squared deviations, extremes),
    combined in the tasks that read them; the frames run over distinct moments, and the rows get theirs by a join. A
    moment with most of the rows is in no single task.
    """
    parts, at = range(len(columns)), F.col("_p")
    rows = df.withColumn("_p", position(df, time_col))
    stats = []
    for i, c in enumerate(columns):
        v = present(df, c).cast("double")
        stats += [F.count(v).alias(f"_n{i}"), F.avg(v).alias(f"_m{i}"), (F.var_pop(v) * F.count(v)).alias(f"_q{i}"), F.min(v).alias(f"_lo{i}"), F.max(v).alias(f"_hi{i}")]
    moments = durable(rows.groupBy(*keys, "_p").agg(*stats))
    # means about the series' own, so that squares stay small
    names = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    centres = moments.groupBy(*names).agg(*[F.avg(f"_m{i}").alias(f"_c{i}") for i in parts])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.lit(True))
    if keys:
        centred = moments.join(centres, same).drop(*[f"_k{i}" for i in range(len(keys))])
    else:
        centred = attach_row(moments, centres, "_s").select("*", "_s.*").drop("_s")

    def stage(w):
        out = {}
        for i in parts:
            n, m = F.col(f"_n{i}"), F.col(f"_m{i}") - F.col(f"_c{i}")
            count, total = F.sum(n).over(w), F.sum(n * m).over(w)
            mean = F.try_divide(total, count)
            dev = F.sum(F.col(f"_q{i}") + n * m * m).over(w) - count * mean * mean
            out[f"_avg{i}"] = mean + F.col(f"_c{i}")
            out[f"_sd{i}"] = F.when(count > 1, F.sqrt(F.greatest(dev, F.lit(0.0)) / (count - 1)))
            out[f"_varies{i}"] = F.max(f"_hi{i}").over(w) > F.min(f"_lo{i}").over(w)  # equal values must not differ by rounding
        return out

    framed = over_range(centred, keys, "_p", stage, window_size, chunk)
    made = [f"{part}{i}" for i in parts for part in ("_avg", "_sd", "_varies")]
    framed = durable(framed.select(*names, at.alias("_kp"), *made))
    both = rows.join(framed, same & at.eqNullSafe(F.col("_kp")), "left")
    flags = {}
    for i, c in enumerate(columns):
        v = present(df, c).cast("double")
        far = F.col(f"_varies{i}") & (F.abs(v - F.col(f"_avg{i}")) > threshold * F.col(f"_sd{i}"))
        flags[f"{c}_anomaly"] = F.coalesce(far, F.lit(False))
    return both.withColumns(flags).select(*df.columns, *flags)
