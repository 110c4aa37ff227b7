"""Profiles and descriptive statistics, one scan per statement."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.columns import attach_row, column_stats, field, literal, missing_sql, name_column, numeric_columns, present, quoted
from ..functions.quantiles import quantiles


def _kind(f: T.StructField) -> str:
    return "numeric" if isinstance(f.dataType, T.NumericType) and not f.name.endswith("_index") else "categorical"


def profile_table(df: DataFrame, sample_key: Sequence[str] = (), samples: int = 5) -> DataFrame:
    """One row per column: type, kind, rows, missing (NULL, NaN, empty text).

    With ``sample_key`` also ``sample``: the column's values in the first rows by key.
    """
    fields = df.schema.fields
    flags = [missing_sql(f, blank=True) for f in fields]
    rows = column_stats(df, df.columns, {"rows": "count(*)", "missing": "count_if(v)"}, flags)
    types = ", ".join(literal(f.dataType.simpleString()) for f in fields)
    kinds = ", ".join(literal(_kind(f)) for f in fields)
    parts = [name_column(df.columns), f"element_at(array({types}), i + 1) AS type", f"element_at(array({kinds}), i + 1) AS kind", "rows", "missing"]
    if sample_key:
        texts = [f"CAST({quoted(f.name)} AS STRING) AS s__{j}" for j, f in enumerate(fields)]
        head = df.orderBy(*sample_key).limit(samples).selectExpr("struct(" + ", ".join([*map(quoted, sample_key), *texts]) + ") AS _r")
        rows = attach_row(rows, head.selectExpr("array_sort(collect_list(_r)) AS _head"), "_taken")
        parts.append(f"element_at(array({', '.join(f'_taken._head.s__{j}' for j in range(len(fields)))}), i + 1) AS sample")
    return rows.selectExpr(*parts)


def missing_pct(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Missing count and percentage per column."""
    names = list(columns or df.columns)
    flags = [missing_sql(field(df, c)) for c in names]
    rows = column_stats(df, names, {"missing": "count_if(v)", "missing_pct": "100D * count_if(v) / count(*)"}, flags)
    return rows.selectExpr(name_column(names), "missing", "missing_pct")


def basic_stats(df: DataFrame, id_cols: Iterable[str] = (), columns: Iterable[str] | None = None) -> DataFrame:
    """Mean, sample deviation, min, max and missing count of every numeric column."""
    names = list(columns or numeric_columns(df, id_cols))
    aggs = {"mean": "avg(v)", "stddev": "stddev_samp(v)", "min": "min(v)", "max": "max(v)", "missing": "count_if(v IS NULL)"}
    return column_stats(df, names, aggs).selectExpr(name_column(names), *aggs)


def describe_stats(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Count, mean, deviation, min, quartiles, max per numeric column (quartiles interpolated)."""
    names = list(columns or numeric_columns(df))
    aggs = {"count": "count(v)", "mean": "avg(v)", "std": "stddev_samp(v)", "min": "min(v)", "max": "max(v)"}
    base = column_stats(df, names, aggs).selectExpr(name_column(names), *aggs)
    q = quantiles(df, names, [0.25, 0.5, 0.75], exact=exact)
    # one row per column name on both sides
    q = q.groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(a) for p, a in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))]
    )
    return base.join(F.broadcast(q), "column", "left").select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def shape_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Skewness and excess kurtosis with the small-sample correction (NULL when undefined)."""
    names = list(columns or numeric_columns(df))
    rows = column_stats(df, names, {"n": "CAST(count(v) AS DOUBLE)", "g1": "skewness(v)", "g2": "kurtosis(v)"})
    return rows.selectExpr(
        name_column(names),
        "CASE WHEN n > 2 AND NOT isnan(g1) THEN sqrt(n * (n - 1)) / (n - 2) * g1 END AS skew",
        "CASE WHEN n > 3 AND NOT isnan(g2) THEN (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6) END AS kurtosis",
    )


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows per value and their share of all rows, most frequent first."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("count"))
    shared = attach_row(counts, df.agg(F.count("*").alias("rows")), "_all")
    out = shared.select("value", "count", (F.col("count") / F.col("_all.rows")).alias("share"))
    out = out.orderBy(F.desc("count"), "value")
    return out.limit(top) if top else out


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bin counts between min and max: ``(bin, lo, hi, count)``, non-empty bins only."""
    v = present(df, column).cast("double")
    rows = df.select(v.alias("_x")).filter(F.col("_x").isNotNull())
    rows = attach_row(rows, rows.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi")), "_s")
    width = (F.col("_s.hi") - F.col("_s.lo")) / F.lit(float(bins))
    at = F.when(width > 0, F.least(F.floor((F.col("_x") - F.col("_s.lo")) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    grouped = rows.select(at.cast("int").alias("bin"), F.col("_s.lo").alias("_lo"), width.alias("_w"))
    return (
        grouped.groupBy("bin", "_lo", "_w")
        .agg(F.count("*").alias("count"))
        .select("bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("lo"), (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("hi"), "count")
    )


def top_groups(df: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` values of ``key`` with most rows (ties by value): at most ``k`` rows."""
    return df.groupBy(key).agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), key).limit(k).select(key)


def box_summary(df: DataFrame, group: str, column: str, top: int | None = 15, exact: bool = True) -> DataFrame:
    """Min, quartiles and max per group, for all groups or the ``top`` largest."""
    rows = df.select(group, column)
    if top:
        rows = rows.join(F.broadcast(top_groups(df, group, top)), group, "left_semi")
    q = quantiles(rows, [column], [0.0, 0.25, 0.5, 0.75, 1.0], keys=[group], exact=exact)
    names = ((0.0, "min"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1.0, "max"))
    return q.groupBy(group).agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(a) for p, a in names])
