"""Cleaning, outliers, imputation, scaling."""

from pyspark.sql import functions as F

from .. import sources as S
from ..functions.scale import durable, scratch_path
from ..operators import cleaning as K
from ..plans import medallion as M
from .registry import R, SQL, STATIONS, WIDE_COLUMNS, city_year, day, query, rounded, station_flat, station_wide, table, with_views

D = "CAST(DATE_PARSED AS VARCHAR) AS d"
ALL = ", ".join(WIDE_COLUMNS)
LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _wide(spark, d, names=WIDE_COLUMNS):
    return station_wide(spark, d).select("DATE_PARSED", *names)


def _out(df):
    return df.select(day("DATE_PARSED").alias("d"), *[c for c in df.columns if c != "DATE_PARSED"])


@query(
    "drop_sparse_rows",
    with_views("station_wide", f"SELECT {D}, {ALL} FROM station_wide WHERE 1 + {' + '.join(f'CAST({c} IS NOT NULL AS INTEGER)' for c in WIDE_COLUMNS)} >= {len(WIDE_COLUMNS) + 1 - 12}"),
)
def drop_sparse_rows(spark, d):
    return _out(K.drop_sparse_rows(_wide(spark, d)))


@query("drop_missing_keys", with_views("city_year", f"SELECT Country, City, Year, AvgYearlyTemp, {R('TempChange')} AS TempChange FROM city_year WHERE Year IS NOT NULL AND TempChange IS NOT NULL"))
def drop_missing_keys(spark, d):
    return rounded(K.drop_missing_keys(city_year(spark, d), ["Year", "TempChange"]).drop("PrevTemp"), "TempChange")


def _silver(spark, d):
    root = scratch_path(spark, "medallion")
    wide = _wide(spark, d).withColumns({"YEAR": F.year("DATE_PARSED"), "MONTH_NUM": F.month("DATE_PARSED")})
    S.write_layer(wide, S.layer_path(root, "bronze", "weather_data"), partition_by="YEAR")
    S.write_layer(city_year(spark, d), S.layer_path(root, "bronze", "temperature_data"), partition_by="Country")
    M.build_silver(spark, root)
    return root


@query(
    "build_silver",
    with_views(
        "station_wide city_year",
        f"""SELECT 'weather_clean' AS name, year(DATE_PARSED) AS part, count(*) AS rows, {R('sum(ST_1_temp_mean)')} AS total FROM station_wide
        WHERE 3 + {' + '.join(f'CAST({c} IS NOT NULL AS INTEGER)' for c in WIDE_COLUMNS)} >= {len(WIDE_COLUMNS) + 3 - 12} GROUP BY 2
        UNION ALL SELECT 'temperature_clean', Year, count(*), {R('sum(AvgYearlyTemp)')} FROM city_year WHERE AvgYearlyTemp IS NOT NULL AND Year IS NOT NULL GROUP BY 2""",
    ),
)
def build_silver(spark, d):
    root = _silver(spark, d)
    parts = []
    for name, part, value in (("weather_clean", "YEAR", "ST_1_temp_mean"), ("temperature_clean", "Year", "AvgYearlyTemp")):
        t = S.read_layer(spark, S.layer_path(root, "silver", name)).groupBy(F.col(part).cast("long").alias("part"))
        parts.append(t.agg(F.lit(name).alias("name"), F.count("*").alias("rows"), F.sum(value).alias("total")))
    return rounded(parts[0].unionByName(parts[1]), "total")


_GOLD = {
    "w": ["weather_cleaned", "weather_features", *[f"ST_{i}_{k}_prediction" for k in ("temp", "rain") for i in (1, 2, 3, 4, 5)]],
    "c": ["temperature_cleaned", "temperature_features", "long_term_temp_prediction"],
}


@query(
    "build_gold",
    with_views(
        "station_wide city_year",
        " UNION ALL ".join(f"SELECT 'gold' AS layer, '{n}' AS name, rows FROM {v}" for v, names in _GOLD.items() for n in names),
        f"""w AS MATERIALIZED (SELECT count(*) AS rows FROM station_wide WHERE 3 + {' + '.join(f'CAST({c} IS NOT NULL AS INTEGER)' for c in WIDE_COLUMNS)} >= {len(WIDE_COLUMNS) + 3 - 12}),
        c AS MATERIALIZED (SELECT count(*) AS rows FROM city_year WHERE AvgYearlyTemp IS NOT NULL AND Year IS NOT NULL)""",
    ),
)
def build_gold(spark, d):
    root = _silver(spark, d)
    M.build_gold(spark, root)
    return S.layer_inventory(spark, root).filter("layer = 'gold'").drop("columns")


def _moments(names, source):
    cells = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in names)
    return f"st AS MATERIALIZED (SELECT {cells} FROM {source})"


@query(
    "zscore_outliers",
    with_views(
        "station_wide",
        f"SELECT {D}, {', '.join(f'coalesce(abs(({c} - m_{c}) / s_{c}) > 2.5, false) AS {c}_outlier' for c in WIDE_COLUMNS)} FROM station_wide, st",
        _moments(WIDE_COLUMNS, "station_wide"),
    ),
)
def zscore_outliers(spark, d):
    return _out(K.zscore_outliers(_wide(spark, d), threshold=2.5, id_cols=["DATE_PARSED"]))


def _quartiles(names, source):
    cells = ", ".join(f"quantile_cont({c}, 0.25) AS a_{c}, quantile_cont({c}, 0.75) AS b_{c}" for c in names)
    return f"st AS MATERIALIZED (SELECT {cells} FROM {source})"


@query(
    "iqr_outliers",
    with_views(
        "station_wide",
        f"SELECT {D}, {', '.join(f'coalesce({c} < a_{c} - 1.5e0 * (b_{c} - a_{c}) OR {c} > b_{c} + 1.5e0 * (b_{c} - a_{c}), false) AS {c}_outlier' for c in WIDE_COLUMNS)} FROM station_wide, st",
        _quartiles(WIDE_COLUMNS, "station_wide"),
    ),
)
def iqr_outliers(spark, d):
    return _out(K.iqr_outliers(durable(_wide(spark, d)), threshold=1.5, id_cols=["DATE_PARSED"]))


def _cap(c, z="3e0"):
    return f"CASE WHEN {c} > m_{c} + {z} * s_{c} THEN m_{c} + {z} * s_{c} WHEN {c} < m_{c} - {z} * s_{c} THEN m_{c} - {z} * s_{c} ELSE {c} END"


@query(
    "outliers_cap",
    with_views("station_wide", f"SELECT {D}, {', '.join(f'{R(_cap(c, str(2)))} AS {c}' for c in WIDE_COLUMNS)} FROM station_wide, st", _moments(WIDE_COLUMNS, "station_wide")),
)
def outliers_cap(spark, d):
    return rounded(_out(K.outliers_cap(_wide(spark, d), z=2.0, id_cols=["DATE_PARSED"])), *WIDE_COLUMNS)


def _remove_chain(names, source, z, ids):
    ctes, prev = [], source
    for i, c in enumerate(names):
        ctes.append(
            f"f{i} AS MATERIALIZED (SELECT p.* FROM {prev} p, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM {prev}) WHERE coalesce(s, 0) = 0 OR abs(({c} - m) / s) <= {z})"
        )
        prev = f"f{i}"
    return ",\n".join(ctes), f"SELECT {ids}, {', '.join(names)} FROM {prev}"


_chain, _last = _remove_chain(WIDE_COLUMNS, "station_wide", 2, D)


@query("outliers_remove", with_views("station_wide", _last, _chain))
def outliers_remove(spark, d):
    return _out(K.outliers_remove(durable(_wide(spark, d)), z=2.0, id_cols=["DATE_PARSED"]))


_tests = " AND ".join(f"abs(({c} - m_{c}) / s_{c}) <= 1.6" for c in LINE)


@query("outliers_remove_once", f"WITH {_moments(LINE, 'lineitem')} SELECT l_orderkey, l_linenumber, {', '.join(LINE)} FROM lineitem, st WHERE {_tests}")
def outliers_remove_once(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *LINE)
    return K.outliers_remove(rows, LINE, z=1.6, sequential=False)


@query(
    "outliers_to_null",
    with_views(
        "station_wide",
        f"SELECT {D}, {', '.join(f'CASE WHEN s_{c} > 0 AND abs(({c} - m_{c}) / s_{c}) > 2 THEN NULL ELSE {c} END AS {c}' for c in WIDE_COLUMNS)} FROM station_wide, st",
        _moments(WIDE_COLUMNS, "station_wide"),
    ),
)
def outliers_to_null(spark, d):
    return _out(K.outliers_to_null(_wide(spark, d), z=2.0, id_cols=["DATE_PARSED"]))


def _impute_sql(fill):
    cells = ", ".join(f"{fill.format(c=c)} AS m_{c}" for c in WIDE_COLUMNS)
    return with_views("station_wide", f"SELECT {D}, {', '.join(f'{R(f'coalesce({c}, m_{c})')} AS {c}' for c in WIDE_COLUMNS)} FROM station_wide, st", f"st AS MATERIALIZED (SELECT {cells} FROM station_wide)")


@query("impute_mean", _impute_sql("avg({c})"))
def impute_mean(spark, d):
    return rounded(_out(K.impute_mean(_wide(spark, d), id_cols=["DATE_PARSED"])), *WIDE_COLUMNS)


@query("impute_median", _impute_sql("quantile_disc({c}, 0.5)"))
def impute_median(spark, d):
    return rounded(_out(K.impute_median(durable(_wide(spark, d)), id_cols=["DATE_PARSED"], exact=True)), *WIDE_COLUMNS)


@query("impute_mode", _impute_sql("(SELECT {c} FROM station_wide WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)").replace("FROM station_wide)\n", ")\n"))
def impute_mode(spark, d):
    return rounded(_out(K.impute_mode(_wide(spark, d), id_cols=["DATE_PARSED"])), *WIDE_COLUMNS)


@query("fill_constant", with_views("station_wide", f"SELECT {D}, {', '.join(f'coalesce({c}, {-1 if c.endswith('temp_mean') else 0}) AS {c}' for c in WIDE_COLUMNS)} FROM station_wide"))
def fill_constant(spark, d):
    return _out(K.fill_constant(_wide(spark, d), {c: (-1.0 if c.endswith("temp_mean") else 0.0) for c in WIDE_COLUMNS}))


#: Bounds of the metrics that have some.
LIMITS = {"temp_mean": (-10, 30), "humidity": (0.1, None), "precipitation": (None, 5)}
_BOUNDS = {f"{s}_{m}": b for s in STATIONS for m, b in LIMITS.items()}
_VALID = [f"coalesce({c} {op} {x}, true)" for c, b in _BOUNDS.items() for op, x in zip((">=", "<="), b) if x is not None]


@query("filter_invalid", with_views("station_wide", f"SELECT {D}, {ALL} FROM station_wide WHERE {' AND '.join(_VALID)}"))
def filter_invalid(spark, d):
    return _out(K.filter_invalid(_wide(spark, d), _BOUNDS))


@query(
    "clean_dataset",
    with_views(
        "station_wide",
        f"SELECT d, {', '.join(f'{R(f'coalesce({c}, a_{c})')} AS {c}' for c in WIDE_COLUMNS)} FROM capped, filled",
        f"""{_moments(WIDE_COLUMNS, 'station_wide')},
        capped AS MATERIALIZED (SELECT {D}, {', '.join(f'{_cap(c)} AS {c}' for c in WIDE_COLUMNS)} FROM station_wide, st),
        filled AS MATERIALIZED (SELECT {', '.join(f'avg({c}) AS a_{c}' for c in WIDE_COLUMNS)} FROM capped)""",
    ),
)
def clean_dataset(spark, d):
    return rounded(_out(K.clean_dataset(_wide(spark, d), ["DATE_PARSED"], "mean", "cap")), *WIDE_COLUMNS)


_chain3, _ = _remove_chain(WIDE_COLUMNS, "station_wide", 3, D)


@query(
    "clean_remove_then_impute",
    with_views(
        "station_wide",
        f"SELECT {D}, {', '.join(f'{R(f'coalesce({c}, a_{c})')} AS {c}' for c in WIDE_COLUMNS)} FROM {(_left := f'f{len(WIDE_COLUMNS) - 1}')}, filled",
        f"{_chain3}, filled AS MATERIALIZED (SELECT {', '.join(f'avg({c}) AS a_{c}' for c in WIDE_COLUMNS)} FROM {_left})",
    ),
)
def clean_remove_then_impute(spark, d):
    """The default path."""
    return rounded(_out(K.clean_dataset(durable(_wide(spark, d)), ["DATE_PARSED"])), *WIDE_COLUMNS)


@query("clean_keep_then_impute", SQL["impute_mode"])
def clean_keep_then_impute(spark, d):
    """Outliers are kept, so this fills only."""
    return rounded(_out(K.clean_dataset(durable(_wide(spark, d)), ["DATE_PARSED"], "mode", "keep")), *WIDE_COLUMNS)


@query(
    "clean_impute_then_cap",
    with_views(
        "station_wide",
        f"SELECT d, {', '.join(f'{R(_cap(c))} AS {c}' for c in WIDE_COLUMNS)} FROM filled, st",
        f"""mean AS MATERIALIZED (SELECT {', '.join(f'avg({c}) AS a_{c}' for c in WIDE_COLUMNS)} FROM station_wide),
        filled AS MATERIALIZED (SELECT {D}, {', '.join(f'coalesce({c}, a_{c}) AS {c}' for c in WIDE_COLUMNS)} FROM station_wide, mean),
        {_moments(WIDE_COLUMNS, 'filled')}""",
    ),
)
def clean_impute_then_cap(spark, d):
    return rounded(_out(K.clean_dataset(_wide(spark, d), ["DATE_PARSED"], "mean", "cap", order="impute_first")), *WIDE_COLUMNS)


_FILLED = ", ".join(f"coalesce({c}, avg({c}) OVER ()) AS {c}" for c in WIDE_COLUMNS)


@query(
    "standardize",
    with_views(
        "station_wide",
        f"SELECT d, {', '.join(f'{R(f'({c} - m_{c}) / s_{c}')} AS {c}_scaled' for c in WIDE_COLUMNS)} FROM whole, st",
        f"whole AS MATERIALIZED (SELECT {D}, {_FILLED} FROM station_wide), {_moments(WIDE_COLUMNS, 'whole')}",
    ),
)
def standardize(spark, d):
    """All rows and columns; gaps are filled with means first, as a row with a gap is dropped by definition."""
    names = [f"{c}_scaled" for c in WIDE_COLUMNS]
    whole = durable(K.impute_mean(_wide(spark, d), id_cols=["DATE_PARSED"]))
    scaled = K.scaled_columns(K.standardize(whole, WIDE_COLUMNS), WIDE_COLUMNS)
    return rounded(scaled.select(day("DATE_PARSED").alias("d"), *names), *names)


ANOMALY = ["temp_mean", "temp_min", "temp_max", "humidity", "precipitation"]


@query(
    "moving_anomalies",
    with_views(
        "station_flat",
        f"""SELECT station, CAST(d AS VARCHAR) AS d, {', '.join(f'coalesce(max({c}) OVER w > min({c}) OVER w AND abs({c} - avg({c}) OVER w) > 2 * stddev_samp({c}) OVER w, false) AS {c}_anomaly' for c in ANOMALY)}
        FROM station_flat WINDOW w AS (PARTITION BY station ORDER BY d RANGE BETWEEN INTERVAL 5 DAY PRECEDING AND INTERVAL 5 DAY FOLLOWING)""",
    ),
)
def moving_anomalies(spark, d):
    out = K.moving_anomalies(station_flat(spark, d), ["station"], "d", ANOMALY)
    return out.select("station", day("d").alias("d"), *[f"{c}_anomaly" for c in ANOMALY])


def _bronze(spark, d, name):
    """Both given views written as CSV, read into typed bronze tables, and one of them read back."""
    root = scratch_path(spark, "bronze")
    stations = station_wide(spark, d).select(F.date_format("DATE_PARSED", "yyyyMMdd").alias("DATE"), F.month("DATE_PARSED").alias("MONTH"), *WIDE_COLUMNS)
    stations.write.option("header", True).csv(f"{root}/weather.csv")
    city_year(spark, d).write.option("header", True).csv(f"{root}/cities.csv")
    M.build_bronze(spark, root, f"{root}/weather.csv", f"{root}/cities.csv")
    return S.read_layer(spark, S.layer_path(root, "bronze", name))


@query("bronze_weather", with_views("station_wide", f"SELECT {D}, {ALL} FROM station_wide"))
def bronze_weather(spark, d):
    return _out(_bronze(spark, d, "weather_data").select("DATE_PARSED", *WIDE_COLUMNS))


@query("bronze_cities", with_views("city_year", f"SELECT Country, City, Year, AvgYearlyTemp, {R('TempChange')} AS TempChange FROM city_year"))
def bronze_cities(spark, d):
    return rounded(_bronze(spark, d, "temperature_data").select("Country", "City", "Year", "AvgYearlyTemp", "TempChange"), "TempChange")
