"""Wide and long forms of the station table, previews and value lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import literal, quoted, require
from ..functions.naming import METRIC_SUFFIXES, station_columns


def melt_stations(
    df: DataFrame, id_cols: Sequence[str], suffixes: Sequence[str] = METRIC_SUFFIXES, drop_null: bool = False
) -> DataFrame:
    """Wide to long: ``(ids..., station, metric, value)``, one row per station column.

    The names are known from the schema, so each value carries its station and metric as
    literals: one projection with a generator, no lookup join.
    """
    require(df, id_cols)
    found = station_columns([c for c in df.columns if c not in set(id_cols)], suffixes)
    if not found:
        raise ValueError("no station columns")
    cells = ", ".join(
        f"named_struct('station', {literal(s)}, 'metric', {literal(m)}, 'value', CAST({quoted(c)} AS DOUBLE))"
        for c, (s, m) in found.items()
    )
    out = df.selectExpr(*map(quoted, id_cols), f"inline(array({cells}))")
    return out.filter("value IS NOT NULL") if drop_null else out


def widen_stations(
    long: DataFrame, id_cols: Sequence[str], pairs: Sequence[tuple[str, str]], value_col: str = "value"
) -> DataFrame:
    """Long to wide for the given (station, metric) pairs: one grouped pass, no pivot-values job."""
    cells = [
        f"max(CASE WHEN station = {literal(s)} AND metric = {literal(m)} THEN {quoted(value_col)} END) AS {quoted(f'{s}_{m}')}"
        for s, m in pairs
    ]
    return long.groupBy(*id_cols).agg(*[F.expr(c) for c in cells])


def station_catalog(df: DataFrame, id_cols: Sequence[str] = ()) -> DataFrame:
    """Station and metric names in the schema, sorted."""
    found = station_columns([c for c in df.columns if c not in set(id_cols)])
    return df.sparkSession.createDataFrame(sorted(found.values()), "station string, metric string")


def preview_rows(df: DataFrame, keys: Sequence[str], n: int = 10000) -> DataFrame:
    """The first ``n`` rows in key order."""
    return df.orderBy(*keys).limit(n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of a column."""
    return df.select(column).distinct().orderBy(column)
