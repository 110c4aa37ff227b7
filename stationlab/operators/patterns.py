"""Baskets, frequent itemsets and association rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, functions as F

from ..functions import cut as C
from ..functions.columns import literal, quoted
from ..functions.naming import station_columns, stations
from . import features as X


@dataclass
class Patterns:
    itemsets: DataFrame
    rules: DataFrame


def build_baskets(df: DataFrame, categorical_cols: Sequence[str], out: str = "items") -> DataFrame:
    """Array of ``"column=value"`` items per row from the columns that exist; NULL gives no item."""
    have = [c for c in categorical_cols if c in df.columns]
    if not have:
        raise ValueError("none of the columns exists")
    items = ", ".join(f"{literal(c + '=')} || CAST({quoted(c)} AS STRING)" for c in have)
    return df.withColumn(out, F.expr(f"array_distinct(array_compact(array({items})))"))


def mine(baskets: DataFrame, min_support: float = 0.1, min_confidence: float = 0.5, items: str = "items") -> Patterns:
    """Parallel FP-growth: itemsets with support, rules with confidence, lift and support.

    Items inside a set are sorted, so the same input always gives the same rows.
    """
    rows = baskets.select(items).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = rows.count()
        model = FPGrowth(itemsCol=items, minSupport=min_support, minConfidence=min_confidence).fit(rows)
    finally:
        rows.unpersist()
    sets = model.freqItemsets.select(
        F.array_sort("items").alias("items"), "freq", (F.col("freq") / F.lit(float(max(n, 1)))).alias("support")
    )
    rules = model.associationRules.select(
        F.array_sort("antecedent").alias("antecedent"), "consequent", "confidence", "lift", "support"
    )
    return Patterns(
        sets.orderBy(F.desc("support"), "items"), rules.orderBy(F.desc("confidence"), F.desc("lift"), "antecedent", "consequent")
    )


def frequent_itemsets(baskets: DataFrame, min_support: float = 0.1, min_confidence: float = 0.5) -> DataFrame:
    return mine(baskets, min_support, min_confidence).itemsets


def association_rules(baskets: DataFrame, min_support: float = 0.1, min_confidence: float = 0.5) -> DataFrame:
    return mine(baskets, min_support, min_confidence).rules


def top_rules(rules: DataFrame, n: int = 10) -> DataFrame:
    """The strongest rules as text."""
    text = F.concat(F.array_join("antecedent", ", "), F.lit(" -> "), F.array_join("consequent", ", "))
    return (
        rules.select(text.alias("rule"), "confidence", "lift")
        .orderBy(F.desc("confidence"), F.desc("lift"), "rule")
        .limit(n)
    )


def precip_category(value):
    return (
        F.when(value == 0, "no_rain").when(value < 1, "light_rain").when(value < 5, "moderate_rain").otherwise("heavy_rain")
    )


def weather_categories(wide: DataFrame, date_col: str, example_stations: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Temperature, humidity and precipitation categories of the stations (all unless named), and the season."""
    chosen = list(example_stations or stations(wide.columns))
    new = {}
    for c, (s, m) in station_columns(wide.columns).items():
        if s not in chosen:
            continue
        v = F.col(c)
        if m == "temp_mean":
            new[f"{s}_temp_category"] = C.ladder(v, *C.TEMP_LADDER)
        elif m == "humidity":
            new[f"{s}_humidity_category"] = C.ladder(v, *C.HUMIDITY_LADDER)
        elif m == "precipitation":
            new[f"{s}_precip_category"] = precip_category(v)
    new["season"] = X.season(F.month(date_col))
    return wide.withColumns(new), list(new)


def weather_patterns(
    wide: DataFrame, date_col: str, min_support: float = 0.05, min_confidence: float = 0.3, example_stations: Sequence[str] | None = None
) -> Patterns:
    df, cols = weather_categories(wide, date_col, example_stations)
    return mine(build_baskets(df, cols), min_support, min_confidence)


TEMPERATURE_ITEMS = ("Country", "temp_regime", "temp_change_category", "decade", "trend")


def temperature_categories(city: DataFrame) -> DataFrame:
    """Regime, change category, decade and trend of the yearly city table (trend from its yearly change)."""
    new = {
        "temp_regime": X.temp_regime(F.col("AvgYearlyTemp")),
        "temp_change_category": C.ladder(F.col("TempChange"), *C.CHANGE_LADDER),
        "decade": X.decade(F.col("Year")),
    }
    if "trend" not in city.columns:
        new["trend"] = X.trend_label(F.col("TempChange"))
    return city.withColumns(new)


def temperature_patterns(city: DataFrame, min_support: float = 0.05, min_confidence: float = 0.3) -> Patterns:
    return mine(build_baskets(temperature_categories(city), TEMPERATURE_ITEMS), min_support, min_confidence)
