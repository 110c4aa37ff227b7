"""Bronze to silver, and the gold feature and training sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.naming import station_columns, stations
from ..operators import cleaning, features as X
from ..sources.layers import layer_path
from ..sources.tables import load_city_table, load_station_table, read_layer, write_layer


WEATHER_IDS = ("DATE", "DATE_PARSED", "YEAR", "MONTH", "MONTH_NUM", "DAY")
CITY_IDS = ("Country", "City", "Year")


def build_bronze(spark: SparkSession, root: str, weather_csv: str, city_csv: str, fmt: str = "parquet") -> None:
    """Read both CSV tables, type them and store the bronze tables."""
    weather, city = load_station_table(spark, weather_csv), load_city_table(spark, city_csv)
    write_layer(weather, layer_path(root, "bronze", "weather_data"), partition_by="YEAR", fmt=fmt)
    write_layer(city, layer_path(root, "bronze", "temperature_data"), partition_by="Country", fmt=fmt)


def silver_weather(bronze: DataFrame, max_missing: int = 12) -> DataFrame:
    return cleaning.drop_sparse_rows(bronze, max_missing)


def silver_temperature(bronze: DataFrame) -> DataFrame:
    return cleaning.drop_missing_keys(bronze, ["Year", "AvgYearlyTemp"])


def build_silver(spark: SparkSession, root: str, fmt: str = "parquet") -> None:
    """Read both bronze tables, drop unusable rows and store the silver tables."""
    weather = read_layer(spark, layer_path(root, "bronze", "weather_data"), fmt)
    city = read_layer(spark, layer_path(root, "bronze", "temperature_data"), fmt)
    write_layer(silver_weather(weather), layer_path(root, "silver", "weather_clean"), partition_by="YEAR", fmt=fmt)
    write_layer(silver_temperature(city), layer_path(root, "silver", "temperature_clean"), partition_by="Country", fmt=fmt)


def weather_features(
    wide: DataFrame,
    date_col: str = "DATE_PARSED",
    example_stations: Sequence[str] | None = None,
    buckets: int = 5,
    exact_buckets: bool = False,
    chunk: int | None = None,
) -> DataFrame:
    """All features of the wide station table.

    ``example_stations`` (default: all) get lags, interaction terms and quantile buckets; a missing
    temperature has no bucket and its row stays. All edges come from one pass over the columns.
    """
    chosen = list(example_stations or stations(wide.columns))
    cols = station_columns(wide.columns)
    lagged = [c for c, (s, m) in cols.items() if s in chosen and m in X.LAG_METRICS]
    temps = {s: c for c, (s, m) in cols.items() if s in chosen and m == "temp_mean"}
    wets = {s: c for c, (s, m) in cols.items() if s in chosen and m == "humidity"}
    d = wide.withColumns({"MONTH_NUM": F.month(date_col), "dayofweek": F.dayofweek(date_col)})
    d = X.cyclical_encoding(d, F.col("MONTH_NUM"), F.col("dayofweek"))
    d = X.rain_flag(X.temp_swing(d))
    d = X.interaction_terms(d, {f"{s}_temp_humidity_interaction": (temps[s], wets[s]) for s in chosen if s in temps and s in wets})
    d = X.lag_features(d, date_col, lagged, chunk=chunk)
    # the edges need only the temperature columns of the input, not the features built so far
    return X.assign_buckets(d, wide, {c: f"{s}_temp_bucket" for s, c in temps.items()}, buckets, exact_buckets)


def temperature_features(city: DataFrame, keys: Sequence[str] = ("Country", "City"), chunk: int | None = None) -> DataFrame:
    """All features of the yearly city table."""
    d = X.temperature_series(city.withColumn("Decade", X.decade(F.col("Year"))), keys, "Year", "AvgYearlyTemp", chunk)
    d = d.withColumn("trend", X.trend_label(F.col("yoy_change")))
    d = X.global_deviation(d, "Year", "AvgYearlyTemp").withColumn("temp_regime", X.temp_regime(F.col("AvgYearlyTemp")))
    return X.city_year_interaction(X.city_index(d))


DATE_COLUMNS = ("DATE_PARSED", "YEAR", "MONTH_NUM", "DAY")
CYCLICAL = ("month_sin", "month_cos", "dayofweek_sin", "dayofweek_cos")


def _dates(df: DataFrame) -> list[str]:
    return [c for c in DATE_COLUMNS if c in df.columns]


def temp_prediction_set(features: DataFrame, station: str) -> DataFrame:
    """Temperature target of one station with humidity and pressure, their lags and the calendar.

    The temperature x humidity product holds the target, so it is left out.
    """
    bases = [f"{station}_humidity", f"{station}_pressure"]
    keep = [c for c in features.columns if any(c == b or c.startswith(b + "_lag") for b in bases)]
    return features.select(*_dates(features), *keep, *CYCLICAL, f"{station}_temp_mean")


def rain_prediction_set(features: DataFrame, station: str) -> DataFrame:
    """Rain label of one station with its other columns; the rain flag equals the label and is left out."""
    own = [
        c
        for c in features.columns
        if c.startswith(station + "_") and "precipitation" not in c and not c.endswith(("_has_rain", "_will_rain"))
    ]
    label = F.when(F.col(f"{station}_precipitation") > 0, 1).otherwise(0).alias(f"{station}_will_rain")
    return features.select(*_dates(features), *own, *CYCLICAL, label)


TREND_FEATURES = (
    "City", "Country", "Year", "Decade", "avg_temp_last_5years", "avg_temp_last_10years",
    "yoy_change", "temp_acceleration", "global_avg_temp",
)


def trend_prediction_set(features: DataFrame) -> DataFrame:
    """Yearly temperature target with its history features."""
    return features.select(*[c for c in TREND_FEATURES if c in features.columns], "AvgYearlyTemp")


def prediction_datasets(weather: DataFrame | None, city: DataFrame | None) -> dict[str, DataFrame]:
    """All training sets that the given feature tables allow, by name."""
    out: dict[str, DataFrame] = {}
    if weather is not None:
        cols = station_columns(weather.columns)
        for s in sorted({s for s, m in cols.values() if m == "temp_mean"}):
            out[f"{s}_temp_prediction"] = temp_prediction_set(weather, s)
        for s in sorted({s for s, m in cols.values() if m == "precipitation"}):
            out[f"{s}_rain_prediction"] = rain_prediction_set(weather, s)
    if city is not None:
        out["long_term_temp_prediction"] = trend_prediction_set(city)
    return out


def write_prediction_datasets(sets: dict[str, DataFrame], root: str, fmt: str = "parquet") -> None:
    for name, df in sets.items():
        write_layer(df, layer_path(root, "gold", name), fmt=fmt)


def build_gold(
    spark: SparkSession, root: str, impute_method: str = "mean", outlier_handling: str = "cap", fmt: str = "parquet", exact_buckets: bool = False
) -> None:
    """Clean the silver tables, build the features from the cleaned tables, then the training sets.

    Every table is stored once and the next step reads it back.
    """

    def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        path = layer_path(root, "gold", name)
        write_layer(df, path, partition_by=partition_by, fmt=fmt)
        return read_layer(spark, path, fmt)

    def cleaned(name: str, ids: Sequence[str], out: str, partition_by: str) -> DataFrame:
        silver = read_layer(spark, layer_path(root, "silver", name), fmt)
        keep = [c for c in ids if c in silver.columns]
        return stored(cleaning.clean_dataset(silver, keep, impute_method, outlier_handling), out, partition_by)

    weather = cleaned("weather_clean", WEATHER_IDS, "weather_cleaned", "YEAR")
    city = cleaned("temperature_clean", CITY_IDS, "temperature_cleaned", "Country")
    weather_gold = stored(weather_features(weather, exact_buckets=exact_buckets), "weather_features", "YEAR")
    city_gold = stored(temperature_features(city), "temperature_features", "Country")
    write_prediction_datasets(prediction_datasets(weather_gold, city_gold), root, fmt)
