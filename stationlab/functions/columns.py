"""Schema-driven column selection and missing-value predicates."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of all numeric columns (decimals included), in schema order."""
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def field(df: DataFrame, name: str) -> T.StructField:
    return df.schema[name]


def require(df: DataFrame, names: Iterable[str]) -> None:
    """Raise when a named column is not there."""
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {absent}; have {df.columns}")


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into NULL, so that aggregates skip both."""
    f = field(df, name)
    c = F.col(f"`{name}`")
    if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c)
    return c


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def value_sql(df: DataFrame, name: str) -> str:
    """:func:`present` as SQL text, cast to double.

    Statements over many columns are written as SQL text: one parsed expression per column
    instead of a chain of column objects.
    """
    c = quoted(name)
    if isinstance(field(df, name).dataType, (T.FloatType, T.DoubleType)):
        return f"nullif(CAST({c} AS DOUBLE), double('NaN'))"
    return f"CAST({c} AS DOUBLE)"


def missing_sql(f: T.StructField, blank: bool = False) -> str:
    """NULL, or NaN for floating columns, or (``blank``) the empty string for text, as SQL text."""
    c = quoted(f.name)
    if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
        return f"({c} IS NULL OR isnan({c}))"
    if blank and isinstance(f.dataType, T.StringType):
        return f"({c} IS NULL OR {c} = '')"
    return f"({c} IS NULL)"


def attach_row(df: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """Add a one-row aggregate to every row as the struct column ``name``.

    The aggregate becomes a scalar subquery: it runs once, its single row is handed to the
    tasks with the plan, and no join (and no unpartitioned window) is involved.
    """
    return df.withColumn(name, one_row.select(F.struct("*").alias("row")).scalar())


def column_stats(df: DataFrame, names: Sequence[str], aggs: dict[str, str], values: Sequence[str] | None = None) -> DataFrame:
    """Rows ``(i, <aggs>)``: the same SQL aggregates over ``v`` for every named column, in one scan.

    The row is turned into (position, value) pairs and grouped by position. With many columns this is
    faster than one aggregate per column side by side: the generated code stays small enough to be
    compiled, and map-side combining leaves one row per column and task.
    """
    cells = ", ".join(values or [value_sql(df, c) for c in names])
    long = df.selectExpr(f"posexplode(array({cells})) AS (i, v)")
    return long.groupBy("i").agg(*[F.expr(text).alias(name) for name, text in aggs.items()])


def stats_row(stats: DataFrame) -> DataFrame:
    """Column statistics as one row with the array ``st``, in column order."""
    return stats.agg(F.array_sort(F.collect_list(F.struct("i", *[c for c in stats.columns if c != "i"]))).alias("st"))


def stat(i: int, part: str, row: str = "_s") -> str:
    """SQL text of one statistic in an attached :func:`stats_row`."""
    return f"get({row}.st, {i}).{part}"


def name_column(names: Sequence[str], index: str = "i", label: str = "column") -> str:
    """SQL text that turns a column position into the column's name."""
    return f"element_at(array({', '.join(map(literal, names))}), {index} + 1) AS {label}"
