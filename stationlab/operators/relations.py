"""Correlations between columns, all pairs in one scan."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, functions as F

from ..functions.columns import name_column, numeric_columns, value_sql
from ..functions.comoments import pair_moments

# The built-in corr() raises on a column without spread under ANSI rules; this gives NULL.
PEARSON = "try_divide(covar_pop(a, b), stddev_pop(a) * stddev_pop(b))"


def _values(df: DataFrame, names: Sequence[str]) -> str:
    return "array(" + ", ".join(value_sql(df, c) for c in names) + ")"


def _all_pairs(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature1, feature2, correlation) for all pairs in column order; rows missing a value are left out of its pairs.

    One scan into blocks of co-moments (``functions/comoments.py``): no row is repeated, and each task sends
    one row per column. NULL where a column has no spread.
    """
    moments = pair_moments(df, names)
    cells = moments.selectExpr("i", "posexplode(arrays_zip(dev, other_dev, co)) AS (k, m)").filter("k > i")
    r = "CASE WHEN m.dev > 0 AND m.other_dev > 0 THEN m.co / (sqrt(m.dev) * sqrt(m.other_dev)) END AS correlation"
    return cells.selectExpr(name_column(names, "i", "feature1"), name_column(names, "k", "feature2"), r)


def _with_target(df: DataFrame, names: Sequence[str], target: str) -> DataFrame:
    """(feature, correlation) of every column with the target, one scan."""
    rows = df.selectExpr(f"{value_sql(df, target)} AS b", f"{_values(df, names)} AS v").filter("b IS NOT NULL")
    long = rows.selectExpr("b", "posexplode(v) AS (i, a)").filter("a IS NOT NULL")
    return long.groupBy("i").agg(F.expr(PEARSON).alias("correlation")).selectExpr(name_column(names, "i", "feature"), "correlation")


def _columns(df: DataFrame, columns: Sequence[str] | None, exclude: Iterable[str]) -> list[str]:
    return list(columns or numeric_columns(df, exclude))


def _usable(r: DataFrame) -> DataFrame:
    return r.filter(F.col("correlation").isNotNull() & ~F.isnan("correlation"))


def correlation_pairs(
    df: DataFrame, columns: Sequence[str] | None = None, limit: int | None = 15, exclude: Iterable[str] = ()
) -> DataFrame:
    """Pearson r of each pair of all columns, strongest first (ties by names); the first ``limit``, None gives all."""
    names = _columns(df, columns, exclude)
    if len(names) < 2:
        raise ValueError("two numeric columns needed")
    out = _usable(_all_pairs(df, names))
    out = out.orderBy(F.abs("correlation").desc(), "feature1", "feature2")
    return out.limit(limit) if limit else out


def correlation_mirror(
    df: DataFrame, columns: Sequence[str] | None = None, limit: int | None = None, exclude: Iterable[str] = ()
) -> DataFrame:
    """Both directions of every pair, without the diagonal."""
    one = correlation_pairs(df, columns, None, exclude)
    both = one.select(
        F.inline(
            F.array(
                F.struct("feature1", "feature2", "correlation"),
                F.struct(F.col("feature2").alias("feature1"), F.col("feature1").alias("feature2"), F.col("correlation")),
            )
        )
    )
    both = both.orderBy(F.abs("correlation").desc(), "feature1", "feature2")
    return both.limit(limit) if limit else both


def correlation_matrix(
    df: DataFrame, columns: Sequence[str] | None = None, exclude: Iterable[str] = (), method: str = "pairwise"
) -> DataFrame:
    """One row per column with a correlation column per column (diagonal 1).

    ``method="vector"`` uses MLlib on rows where all columns are present.
    """
    names = _columns(df, columns, exclude)
    if method == "vector":
        vec = VectorAssembler(inputCols=names, outputCol="_v", handleInvalid="skip").transform(df.select(*names)).select("_v")
        m = Correlation.corr(vec, "_v").head()[0].toArray()
        return df.sparkSession.createDataFrame(
            [(n, *[float(x) for x in m[i]]) for i, n in enumerate(names)],
            "feature1 string, " + ", ".join(f"`{n}` double" for n in names),
        )
    both = correlation_mirror(df, names)
    diagonal = df.limit(1).select(F.inline(F.array(*[F.struct(F.lit(n).alias("feature1"), F.lit(n).alias("feature2"), F.lit(1.0).alias("correlation")) for n in names])))
    return both.unionByName(diagonal).groupBy("feature1").pivot("feature2", names).agg(F.max("correlation"))


def target_correlations(
    df: DataFrame, target: str, columns: Sequence[str] | None = None, limit: int | None = 10, exclude: Iterable[str] = ()
) -> DataFrame:
    """Columns most correlated with the target: the first ``limit``, which is the operator's definition; None gives all."""
    names = [c for c in (columns or numeric_columns(df, exclude)) if c != target]
    out = _usable(_with_target(df, names, target))
    out = out.orderBy(F.abs("correlation").desc(), "feature")
    return out.limit(limit) if limit else out
