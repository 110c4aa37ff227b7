"""Calendar, window, bucket and category features; feature and training sets."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import cut as C
from ..functions.scale import durable
from ..operators import features as X
from ..plans import medallion as M
from .registry import METRICS, R, STATIONS, WIDE_COLUMNS, city_month, city_temps, city_year, day, query, rounded, station_flat, station_long, station_wide, table, with_views

PI = "pi()"


@query(
    "calendar_features",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
    CAST(dayofweek(ts) + 1 AS INTEGER) AS dayofweek, monthname(ts) AS month_name, dayname(ts) AS day_name, CAST(hour(ts) AS INTEGER) AS hour FROM events""",
)
def calendar_features(spark, d):
    return X.calendar_features(table(spark, d, "events").select("event_id", "ts"), "ts").drop("ts")


CYC = {
    "month_sin": f"sin(month(DATE_PARSED) * 2 * {PI} / 12)",
    "month_cos": f"cos(month(DATE_PARSED) * 2 * {PI} / 12)",
    "dayofweek_sin": f"sin((dayofweek(DATE_PARSED) + 1) * 2 * {PI} / 7)",
    "dayofweek_cos": f"cos((dayofweek(DATE_PARSED) + 1) * 2 * {PI} / 7)",
}
CYC_SQL = ", ".join(f"{R(e)} AS {n}" for n, e in CYC.items())


@query("cyclical_encoding", with_views("station_wide", f"SELECT CAST(DATE_PARSED AS VARCHAR) AS d, {CYC_SQL} FROM station_wide"))
def cyclical_encoding(spark, d):
    dates = station_wide(spark, d).select("DATE_PARSED")
    out = X.cyclical_encoding(dates, F.month("DATE_PARSED"), F.dayofweek("DATE_PARSED"))
    return rounded(out.select(day("DATE_PARSED").alias("d"), *CYC), *CYC)


def _wide_query(name, columns, fn):
    """A query that adds station columns to the wide table."""
    sql = with_views("station_wide", f"SELECT CAST(DATE_PARSED AS VARCHAR) AS d, {', '.join(f'{e} AS {n}' for n, e in columns.items())} FROM station_wide")

    @query(name, sql)
    def run(spark, d):
        return fn(station_wide(spark, d)).select(day("DATE_PARSED").alias("d"), *columns)

    return run


_wide_query("temp_swing", {f"{s}_temp_swing": f"{s}_temp_max - {s}_temp_min" for s in STATIONS}, X.temp_swing)
_wide_query("interaction_terms", {f"{s}_temp_humidity_interaction": f"{s}_temp_mean * {s}_humidity" for s in STATIONS}, X.interaction_terms)
_wide_query("rain_flag", {f"{s}_has_rain": f"CASE WHEN {s}_precipitation > 0 THEN 1 ELSE 0 END" for s in STATIONS}, X.rain_flag)

_SERIES = "WINDOW w AS (PARTITION BY station, metric ORDER BY d)"


@query(
    "lag_features",
    with_views("station_long", f"SELECT station, metric, CAST(d AS VARCHAR) AS d, value, {', '.join(f'lag(value, {k}) OVER w AS value_lag{k}' for k in X.LAGS)} FROM station_long {_SERIES}"),
)
def lag_features(spark, d):
    return X.lag_features(station_long(spark, d), "d", ["value"], keys=["station", "metric"]).withColumn("d", day("d"))


@query("lead_targets", with_views("station_long", f"SELECT station, metric, CAST(d AS VARCHAR) AS d, value, lead(value) OVER w AS next_value FROM station_long {_SERIES}"))
def lead_targets(spark, d):
    return X.lead_targets(station_long(spark, d), "d", {"value": "next_value"}, ["station", "metric"]).withColumn("d", day("d"))


def _edges(column, source, where="true"):
    return "list_distinct([" + ", ".join(f"(SELECT quantile_cont({column}, {p}) FROM {source} WHERE {where})" for p in (0.2, 0.4, 0.6, 0.8)) + "])"


def _bucket(column, edges):
    return f"CAST(len(list_filter({edges}, lambda e: e <= {column})) AS DOUBLE)"


@query(
    "quantile_bucket",
    with_views("station_flat", f"SELECT station, CAST(d AS VARCHAR) AS d, {_bucket('temp_mean', 'edges')} AS temp_bucket FROM station_flat, e", f"e AS MATERIALIZED (SELECT {_edges('temp_mean', 'station_flat')} AS edges)"),
)
def quantile_bucket(spark, d):
    out = X.quantile_bucket(durable(station_flat(spark, d)), "temp_mean", "temp_bucket", exact=True)
    return out.select("station", day("d").alias("d"), "temp_bucket")


def _cut_sql(c, edges, labels, right=True):
    tests = []
    for i, label in enumerate(labels):
        a, b = edges[i], edges[i + 1]
        tests.append(f"WHEN {c} > {a} AND {c} <= {b} THEN '{label}'" if right else f"WHEN {c} >= {a} AND {c} < {b} THEN '{label}'")
    return f"CASE {' '.join(tests)} END"


@query(
    "fixed_bucket",
    with_views("station_flat", f"SELECT station, CAST(d AS VARCHAR) AS d, {_cut_sql('temp_mean', *C.TEMP_BINS)} AS temp_mean_category, {_cut_sql('precipitation', *C.PRECIP_BINS)} AS precipitation_category FROM station_flat"),
)
def fixed_bucket(spark, d):
    out = X.fixed_bucket(X.fixed_bucket(station_flat(spark, d), "temp_mean", *C.TEMP_BINS), "precipitation", *C.PRECIP_BINS)
    return out.select("station", day("d").alias("d"), "temp_mean_category", "precipitation_category")


@query("change_bucket", with_views("city_year", f"SELECT Country, City, Year, {_cut_sql('TempChange', *C.CHANGE_BINS)} AS TempChange_category FROM city_year"))
def change_bucket(spark, d):
    return X.fixed_bucket(city_year(spark, d), "TempChange", *C.CHANGE_BINS).select("Country", "City", "Year", "TempChange_category")


@query("sql_transform", with_views("station_flat", f"SELECT station, CAST(d AS VARCHAR) AS d, temp_mean, {R('temp_mean * 9 / 5 + 32')} AS temp_f FROM station_flat WHERE humidity > 0"))
def sql_transform(spark, d):
    rows = station_flat(spark, d).withColumn("d", day("d"))
    return rounded(X.sql_transform(rows, "SELECT station, d, temp_mean, temp_mean * 9 / 5 + 32 AS temp_f FROM __THIS__ WHERE humidity > 0"), "temp_f")


def _ladder_sql(c, edges, labels):
    return "CASE " + " ".join(f"WHEN {c} < {e} THEN '{n}'" for e, n in zip(edges, labels)) + f" ELSE '{labels[-1]}' END"


SEASON_SQL = "CASE WHEN month({c}) BETWEEN 3 AND 5 THEN 'spring' WHEN month({c}) BETWEEN 6 AND 8 THEN 'summer' WHEN month({c}) BETWEEN 9 AND 11 THEN 'fall' ELSE 'winter' END"


@query("season_category", f"SELECT o_orderkey, {SEASON_SQL.format(c='o_orderdate')} AS season FROM orders")
def season_category(spark, d):
    return table(spark, d, "orders").select("o_orderkey", X.season(F.month("o_orderdate")).alias("season"))


@query("decade", "SELECT o_orderkey, CAST(floor(year(o_orderdate) / 10) * 10 AS INTEGER) AS decade FROM orders")
def decade(spark, d):
    return table(spark, d, "orders").select("o_orderkey", X.decade(F.year("o_orderdate")).alias("decade"))


CITY = ["Country", "City"]
_YEARS = "(PARTITION BY Country, City ORDER BY Year"
_MONTHS = "(PARTITION BY Country, City ORDER BY mi"


@query(
    "rolling_mean_prior",
    with_views("city_month", f"SELECT Country, City, mi, Temp, {', '.join(f'{R(f'avg(Temp) OVER {_MONTHS} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)')} AS avg_last_{n}' for n in (5, 10))} FROM city_month"),
)
def rolling_mean_prior(spark, d):
    return rounded(X.rolling_mean_prior(city_month(spark, d), CITY, "mi", "Temp", name="avg_last_{n}"), "avg_last_5", "avg_last_10")


@query(
    "diff_from_rolling",
    with_views("city_year", f"SELECT Country, City, Year, {', '.join(f'{R(f'AvgYearlyTemp - avg(AvgYearlyTemp) OVER {_YEARS} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)')} AS diff_from_{n}yr_avg' for n in (5, 10))} FROM city_year"),
)
def diff_from_rolling(spark, d):
    names = ["diff_from_5yr_avg", "diff_from_10yr_avg"]
    return rounded(X.diff_from_rolling(city_temps(spark, d), CITY, "Year", "AvgYearlyTemp").select(*CITY, "Year", *names), *names)


@query("yoy_change", with_views("city_temps", f"SELECT Country, City, Year, AvgYearlyTemp, lag(AvgYearlyTemp) OVER w AS prev_year_temp, {R('AvgYearlyTemp - lag(AvgYearlyTemp) OVER w')} AS yoy_change FROM city_temps WINDOW w AS {_YEARS})"))
def yoy_change(spark, d):
    return rounded(X.yoy_change(city_temps(spark, d), CITY, "Year", "AvgYearlyTemp"), "yoy_change")


TREND_SQL = "CASE WHEN {c} > {t} THEN '{a}' WHEN {c} < -{t} THEN '{b}' ELSE '{o}' END"


@query(
    "trend_label",
    with_views(
        "city_year",
        f"""SELECT Country, City, Year, {TREND_SQL.format(c='TempChange', t=0.1, a='warming', b='cooling', o='stable')} AS trend,
        {TREND_SQL.format(c='TempChange', t=0.2, a='Increasing', b='Decreasing', o='Stable')} AS change_trend FROM city_year""",
    ),
)
def trend_label(spark, d):
    c = F.col("TempChange")
    return city_year(spark, d).select(
        *CITY, "Year", X.trend_label(c).alias("trend"), X.trend_label(c, X.CHANGE_TREND_THRESHOLD, X.CHANGE_TREND_LABELS).alias("change_trend")
    )


@query(
    "acceleration",
    with_views(
        "city_year",
        f"SELECT Country, City, Year, {R('lag(TempChange) OVER w')} AS prev_yoy_change, {R('TempChange - lag(TempChange) OVER w')} AS temp_acceleration FROM city_year WINDOW w AS {_YEARS})",
    ),
)
def acceleration(spark, d):
    names = ["prev_yoy_change", "temp_acceleration"]
    return rounded(X.acceleration(city_temps(spark, d), CITY, "Year", "AvgYearlyTemp").select(*CITY, "Year", *names), *names)


@query(
    "global_deviation",
    with_views("city_temps", f"SELECT Country, City, Year, {R('avg(AvgYearlyTemp) OVER y')} AS global_avg_temp, {R('AvgYearlyTemp - avg(AvgYearlyTemp) OVER y')} AS deviation_from_global_avg FROM city_temps WINDOW y AS (PARTITION BY Year)"),
)
def global_deviation(spark, d):
    names = ["global_avg_temp", "deviation_from_global_avg"]
    return rounded(X.global_deviation(city_temps(spark, d), "Year", "AvgYearlyTemp").select(*CITY, "Year", *names), *names)


@query("temp_regime", with_views("city_month", f"SELECT Country, City, mi, {_ladder_sql('Temp', *C.REGIME_LADDER)} AS temp_regime FROM city_month"))
def temp_regime(spark, d):
    return city_month(spark, d).select(*CITY, "mi", X.temp_regime(F.col("Temp")).alias("temp_regime"))


@query("city_index", with_views("city_temps", "SELECT Country, City, Year, CAST(dense_rank() OVER (ORDER BY City) - 1 AS DOUBLE) AS city_index FROM city_temps"))
def city_index(spark, d):
    return X.city_index(city_temps(spark, d)).select(*CITY, "Year", "city_index")


@query("city_year_interaction", with_views("city_temps", "SELECT Country, City, Year, (dense_rank() OVER (ORDER BY City) - 1) * (Year - 1700e0) AS city_year_interaction FROM city_temps"))
def city_year_interaction(spark, d):
    return X.city_year_interaction(X.city_index(city_temps(spark, d))).select(*CITY, "Year", "city_year_interaction")


# -- whole feature sets -------------------------------------------------------------------

LAGGED = [f"{s}_{m}" for s in STATIONS for m in ("temp_mean", "humidity")]
_FEATURES = {
    "YEAR": "CAST(year(DATE_PARSED) AS INTEGER)",
    "MONTH_NUM": "CAST(month(DATE_PARSED) AS INTEGER)",
    "DAY": "CAST(day(DATE_PARSED) AS INTEGER)",
    "dayofweek": "CAST(dayofweek(DATE_PARSED) + 1 AS INTEGER)",
    **{n: R(e) for n, e in CYC.items()},
    **{f"{s}_temp_swing": R(f"{s}_temp_max - {s}_temp_min") for s in STATIONS},
    **{f"{s}_has_rain": f"CASE WHEN {s}_precipitation > 0 THEN 1 ELSE 0 END" for s in STATIONS},
    **{f"{s}_temp_humidity_interaction": R(f"{s}_temp_mean * {s}_humidity") for s in STATIONS},
    **{f"{c}_lag{k}": f"lag({c}, {k}) OVER w" for c in LAGGED for k in (1, 2, 3)},
}
ROUNDED = [*CYC, *[f"{s}_temp_swing" for s in STATIONS], *[f"{s}_temp_humidity_interaction" for s in STATIONS]]
_BASE = f"""f AS MATERIALIZED (SELECT *, {', '.join(f'{e} AS {n}' for n, e in _FEATURES.items())} FROM station_wide WINDOW w AS (ORDER BY DATE_PARSED)),
e AS MATERIALIZED (SELECT {', '.join(f"{_edges(f'{s}_temp_mean', 'station_wide', 'true')} AS edges_{s}" for s in STATIONS)}),
wf AS MATERIALIZED (SELECT f.*, {', '.join(f"CASE WHEN {s}_temp_mean IS NOT NULL THEN {_bucket(f'{s}_temp_mean', f'edges_{s}')} END AS {s}_temp_bucket" for s in STATIONS)} FROM f, e)"""
_FEATURE_NAMES = [*WIDE_COLUMNS, *_FEATURES, *[f"{s}_temp_bucket" for s in STATIONS]]


def _weather(spark, d):
    # as in the layered flow, features start from a stored table
    wide = durable(station_wide(spark, d).withColumns({"YEAR": F.year("DATE_PARSED"), "DAY": F.dayofmonth("DATE_PARSED")}))
    return rounded(M.weather_features(wide, exact_buckets=True), *ROUNDED)


def _dated(df):
    return df.withColumn("DATE_PARSED", day("DATE_PARSED"))


def _weather_sql(names):
    return with_views("station_wide", f"SELECT CAST(DATE_PARSED AS VARCHAR) AS DATE_PARSED, {', '.join(names)} FROM wf", _BASE)


@query("weather_features", _weather_sql(_FEATURE_NAMES))
def weather_features(spark, d):
    return _dated(_weather(spark, d)).select("DATE_PARSED", *_FEATURE_NAMES)


def _long_sql(names):
    """One block of rows per station; ``names`` with the station's prefix lose it."""
    blocks = [f"SELECT '{s}' AS station, CAST(DATE_PARSED AS VARCHAR) AS DATE_PARSED, {', '.join(n.replace('@', s + '_') + ' AS ' + n.replace('@', '') for n in names)} FROM wf" for s in STATIONS]
    return with_views("station_wide", " UNION ALL ".join(blocks), _BASE)


def _by_station(weather, make):
    blocks = []
    for s in STATIONS:
        one = make(weather, s)
        blocks.append(one.select(F.lit(s).alias("station"), *[F.col(c).alias(c.removeprefix(f"{s}_")) for c in one.columns]))
    return _dated(reduce(DataFrame.unionByName, blocks))


_PRED = ["YEAR", "MONTH_NUM", "DAY", "@humidity", "@humidity_lag1", "@humidity_lag2", "@humidity_lag3", *CYC, "@temp_mean"]


@query("temp_prediction_set", _long_sql(_PRED))
def temp_prediction_set(spark, d):
    return _by_station(durable(_weather(spark, d)), M.temp_prediction_set)


_RAIN = ["@" + n.removeprefix("ST_1_") for n in _FEATURE_NAMES if n.startswith("ST_1_") and "precipitation" not in n and "has_rain" not in n]


@query("rain_prediction_set", _long_sql(["YEAR", "MONTH_NUM", "DAY", *_RAIN, *CYC, "@has_rain"]).replace("AS has_rain", "AS will_rain"))
def rain_prediction_set(spark, d):
    return _by_station(durable(_weather(spark, d)), M.rain_prediction_set)


_T = "AvgYearlyTemp"
_CITY_FEATURES = {
    "Decade": "CAST(floor(Year / 10) * 10 AS INTEGER)",
    **{f"avg_temp_last_{n}years": R(f"avg({_T}) OVER {_YEARS} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)") for n in (5, 10)},
    **{f"diff_from_{n}yr_avg": R(f"{_T} - avg({_T}) OVER {_YEARS} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)") for n in (5, 10)},
    "prev_year_temp": "PrevTemp",
    "yoy_change": R("TempChange"),
    "trend": TREND_SQL.format(c="TempChange", t=0.1, a="warming", b="cooling", o="stable"),
    "prev_yoy_change": R(f"lag(TempChange) OVER {_YEARS})"),
    "temp_acceleration": R(f"TempChange - lag(TempChange) OVER {_YEARS})"),
    "global_avg_temp": R(f"avg({_T}) OVER (PARTITION BY Year)"),
    "deviation_from_global_avg": R(f"{_T} - avg({_T}) OVER (PARTITION BY Year)"),
    "temp_regime": _ladder_sql(_T, *C.REGIME_LADDER),
    "city_index": "CAST(dense_rank() OVER (ORDER BY City) - 1 AS DOUBLE)",
    "city_year_interaction": "(dense_rank() OVER (ORDER BY City) - 1) * (Year - 1700e0)",
}
_CITY_ROUNDED = [n for n, e in _CITY_FEATURES.items() if e.startswith("(round")]


def _temperature(spark, d):
    return rounded(M.temperature_features(city_temps(spark, d)), *_CITY_ROUNDED)


@query(
    "temperature_features",
    with_views("city_year", f"SELECT Country, City, Year, {_T}, {', '.join(f'{e} AS {n}' for n, e in _CITY_FEATURES.items())} FROM city_year"),
)
def temperature_features(spark, d):
    return _temperature(spark, d).select("Country", "City", "Year", _T, *_CITY_FEATURES)


@query(
    "trend_prediction_set",
    with_views("city_year", f"SELECT Country, City, Year, {', '.join(f'{_CITY_FEATURES[n]} AS {n}' for n in M.TREND_FEATURES if n in _CITY_FEATURES)}, {_T} FROM city_year"),
)
def trend_prediction_set(spark, d):
    return M.trend_prediction_set(_temperature(spark, d))


# -- categories for pattern mining --------------------------------------------------------


@query("temp_category", with_views("station_flat", f"SELECT station, CAST(d AS VARCHAR) AS d, {_ladder_sql('temp_mean', *C.TEMP_LADDER)} AS temp_category FROM station_flat"))
def temp_category(spark, d):
    return station_flat(spark, d).select("station", day("d").alias("d"), C.ladder(F.col("temp_mean"), *C.TEMP_LADDER).alias("temp_category"))


@query("humidity_category", with_views("station_flat", f"SELECT station, CAST(d AS VARCHAR) AS d, {_ladder_sql('humidity', *C.HUMIDITY_LADDER)} AS humidity_category FROM station_flat"))
def humidity_category(spark, d):
    return station_flat(spark, d).select("station", day("d").alias("d"), C.ladder(F.col("humidity"), *C.HUMIDITY_LADDER).alias("humidity_category"))
