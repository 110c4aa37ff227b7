"""Grouped summaries of the station and city tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

COMPARE_METRICS = ("temp_mean", "humidity", "pressure")
MONTHLY_METRICS = ("temp_mean", "humidity", "precipitation")


def _pick(long: DataFrame, stations: Sequence[str] | None, metrics: Sequence[str]) -> DataFrame:
    out = long.filter(F.col("metric").isin(*metrics))
    return out.filter(F.col("station").isin(*stations)) if stations else out


def station_comparison(
    long: DataFrame, stations: Sequence[str] | None = None, metrics: Sequence[str] = COMPARE_METRICS
) -> DataFrame:
    """Mean per metric and station."""
    return (
        _pick(long, stations, metrics)
        .groupBy("metric", "station")
        .agg(F.avg("value").alias("mean"))
        .filter(F.col("mean").isNotNull())
    )


def monthly_patterns(
    long: DataFrame,
    date_col: str,
    stations: Sequence[str] | None = None,
    metrics: Sequence[str] = MONTHLY_METRICS,
) -> DataFrame:
    """Mean, deviation, min and max per calendar month, station and metric; all stations unless some are named."""
    rows = _pick(long, stations, metrics)
    return (
        rows.groupBy(F.month(date_col).alias("month"), "station", "metric")
        .agg(
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("stddev"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
        .filter(F.col("mean").isNotNull())
    )


def yearly_trends(
    city: DataFrame,
    cities: Sequence[str] | None = None,
    start_year: int | None = None,
    end_year: int | None = None,
    top: int = 5,
) -> DataFrame:
    """Yearly temperature of the named cities, or of the ``top`` cities by rows in the year range.

    A city is its name and country; the top is the operator's definition.
    """
    rows = city
    if start_year is not None:
        rows = rows.filter(F.col("Year") >= start_year)
    if end_year is not None:
        rows = rows.filter(F.col("Year") <= end_year)
    if cities:
        rows = rows.filter(F.col("City").isin(*cities))
    else:
        most = rows.groupBy("Country", "City").count().orderBy(F.desc("count"), "City", "Country").limit(top)
        rows = rows.join(most, ["Country", "City"], "left_semi")
    return rows.select("Country", "City", "Year", "AvgYearlyTemp").orderBy("City", "Country", "Year")
