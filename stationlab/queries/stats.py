"""Profiles, descriptive statistics, correlations and grouped summaries."""

from itertools import combinations

from pyspark.sql import functions as F

from ..functions.scale import durable
from ..operators import climate, profile as P, relations
from .registry import R, WIDE_COLUMNS, city_temps, city_year, query, r8, rounded, station_long, station_wide, table, with_views

PROFILE_TYPES = {
    "event_id": ("bigint", "numeric"), "ts": ("timestamp_ntz", "categorical"), "user_id": ("bigint", "numeric"),
    "event_type": ("string", "categorical"), "value": ("double", "numeric"), "props": ("string", "categorical"),
}


def _profile_sql():
    parts = []
    for c, (t, k) in PROFILE_TYPES.items():
        blank = f" OR {c} = ''" if t == "string" else f" OR isnan({c})" if t == "double" else ""
        sample = f"(SELECT string_agg(CAST({c} AS VARCHAR), '|' ORDER BY event_id) FROM (SELECT * FROM events ORDER BY event_id LIMIT 5))"
        parts.append(
            f"SELECT '{c}' AS \"column\", '{t}' AS type, '{k}' AS kind, count(*) AS rows, count(*) FILTER ({c} IS NULL{blank}) AS missing, {sample} AS sample FROM events"
        )
    return " UNION ALL ".join(parts)


@query("profile_table", _profile_sql())
def profile_table(spark, d):
    return P.profile_table(table(spark, d, "events"), ["event_id"]).withColumn("sample", F.array_join("sample", "|"))


def _per_column(names, line, source):
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {line.replace('{c}', c)} FROM {source}" for c in names)


@query(
    "missing_pct",
    with_views("station_wide", _per_column(WIDE_COLUMNS, f"count(*) - count({{c}}) AS missing, {R('100e0 * (count(*) - count({c})) / count(*)')} AS missing_pct", "station_wide")),
)
def missing_pct(spark, d):
    return rounded(P.missing_pct(station_wide(spark, d), WIDE_COLUMNS), "missing_pct")


@query(
    "basic_stats",
    with_views(
        "station_wide",
        _per_column(WIDE_COLUMNS, f"{R('avg({c})')} AS mean, {R('stddev_samp({c})')} AS stddev, min({{c}}) AS min, max({{c}}) AS max, count(*) - count({{c}}) AS missing", "station_wide"),
    ),
)
def basic_stats(spark, d):
    return rounded(P.basic_stats(station_wide(spark, d), ["DATE_PARSED"]), "mean", "stddev")


LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "describe_stats",
    _per_column(
        LINE_COLUMNS,
        f"count({{c}}) AS count, {R('avg({c})')} AS mean, {R('stddev_samp({c})')} AS std, min({{c}}) AS min, "
        + ", ".join(f"{R('quantile_cont({c}, ' + str(p) + ')')} AS q{int(p * 100)}" for p in (0.25, 0.5, 0.75))
        + ", max({c}) AS max",
        "lineitem",
    ),
)
def describe_stats(spark, d):
    return rounded(P.describe_stats(table(spark, d, "lineitem"), LINE_COLUMNS), "mean", "std", "q25", "q50", "q75")


@query("shape_stats", _per_column(LINE_COLUMNS, f"{R('skewness({c})')} AS skew, {R('kurtosis({c})')} AS kurtosis", "lineitem"))
def shape_stats(spark, d):
    return rounded(P.shape_stats(table(spark, d, "lineitem"), LINE_COLUMNS), "skew", "kurtosis")


def _corr_sql(names, source):
    return " UNION ALL ".join(f"SELECT '{a}' AS feature1, '{b}' AS feature2, corr({a}, {b}) AS r FROM {source}" for a, b in combinations(names, 2))


@query(
    "correlation_pairs",
    with_views("station_wide", f"SELECT feature1, feature2, {R('r')} AS correlation FROM c WHERE r IS NOT NULL AND NOT isnan(r) ORDER BY abs(r) DESC, feature1, feature2 LIMIT 15", f"c AS ({_corr_sql(WIDE_COLUMNS, 'station_wide')})"),
)
def correlation_pairs(spark, d):
    return rounded(relations.correlation_pairs(station_wide(spark, d), exclude=["DATE_PARSED"]), "correlation")


MATRIX_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query(
    "correlation_matrix",
    "WITH c AS MATERIALIZED (" + _corr_sql(MATRIX_COLUMNS, "lineitem") + "), m AS (SELECT feature1, feature2, r FROM c UNION ALL SELECT feature2, feature1, r FROM c"
    + "".join(f" UNION ALL SELECT '{c}', '{c}', 1e0" for c in MATRIX_COLUMNS) + ") SELECT feature1, "
    + ", ".join(f"{R(f'''max(CASE WHEN feature2 = '{c}' THEN r END)''')} AS {c}" for c in MATRIX_COLUMNS) + " FROM m GROUP BY 1",
)
def correlation_matrix(spark, d):
    return rounded(relations.correlation_matrix(table(spark, d, "lineitem"), MATRIX_COLUMNS), *MATRIX_COLUMNS)


@query(
    "correlation_mirror",
    "WITH c AS MATERIALIZED (" + _corr_sql(MATRIX_COLUMNS, "lineitem") + f"), m AS (SELECT * FROM c UNION ALL SELECT feature2, feature1, r FROM c) SELECT feature1, feature2, {R('r')} AS correlation FROM m ORDER BY abs(r) DESC, feature1, feature2 LIMIT 15",
)
def correlation_mirror(spark, d):
    return rounded(relations.correlation_mirror(table(spark, d, "lineitem"), MATRIX_COLUMNS, 15), "correlation")


@query(
    "target_correlations",
    with_views(
        "station_wide",
        f"SELECT feature, {R('r')} AS correlation FROM c WHERE r IS NOT NULL ORDER BY abs(r) DESC, feature LIMIT 10",
        "c AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, ST_1_temp_mean) AS r FROM station_wide" for c in WIDE_COLUMNS if c != "ST_1_temp_mean") + ")",
    ),
)
def target_correlations(spark, d):
    return rounded(relations.target_correlations(station_wide(spark, d), "ST_1_temp_mean"), "correlation")


@query(
    "station_comparison",
    with_views("station_long", f"SELECT metric, station, {R('avg(value)')} AS mean FROM station_long WHERE metric IN ('temp_mean', 'humidity', 'pressure') GROUP BY 1, 2"),
)
def station_comparison(spark, d):
    return rounded(climate.station_comparison(station_long(spark, d)), "mean")


@query(
    "yearly_trends",
    with_views(
        "city_year",
        "SELECT Country, City, Year, AvgYearlyTemp FROM city_year SEMI JOIN t USING (Country, City) WHERE Year BETWEEN 1996 AND 2000",
        "t AS (SELECT Country, City FROM city_year WHERE Year BETWEEN 1996 AND 2000 GROUP BY Country, City ORDER BY count(*) DESC, City, Country LIMIT 5)",
    ),
)
def yearly_trends(spark, d):
    return climate.yearly_trends(city_year(spark, d), start_year=1996, end_year=2000)


@query(
    "monthly_patterns",
    with_views(
        "station_long",
        f"""SELECT CAST(month(d) AS INTEGER) AS month, station, metric, {R('avg(value)')} AS mean, {R('stddev_samp(value)')} AS stddev, min(value) AS min, max(value) AS max
        FROM station_long WHERE metric IN ('temp_mean', 'humidity', 'precipitation') GROUP BY 1, 2, 3""",
    ),
)
def monthly_patterns(spark, d):
    return rounded(climate.monthly_patterns(station_long(spark, d), "d"), "mean", "stddev")


@query(
    "value_counts",
    f"""SELECT source AS value, count(*) AS count, {R('count(*) / (SELECT count(*) FROM documents)')} AS share
    FROM documents GROUP BY 1 ORDER BY count DESC, value LIMIT 10""",
)
def value_counts(spark, d):
    return rounded(P.value_counts(table(spark, d, "documents").select("source"), "source", 10), "share")


@query(
    "histogram",
    f"""WITH s AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 30e0 AS w FROM orders),
    b AS (SELECT CAST(least(floor((o_totalprice - lo) / w), 29) AS INTEGER) AS bin, lo, w FROM orders, s)
    SELECT bin, {R('lo + bin * w')} AS lo, {R('lo + (bin + 1) * w')} AS hi, count(*) AS count FROM b GROUP BY bin, b.lo, w""",
)
def histogram(spark, d):
    return rounded(P.histogram(table(spark, d, "orders"), "o_totalprice", 30), "lo", "hi")


@query(
    "box_summary",
    with_views(
        "city_year",
        "SELECT Country, "
        + ", ".join(f"{R(f'quantile_cont(AvgYearlyTemp, {p})')} AS {n}" for p, n in ((0.0, "min"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1.0, "max")))
        + " FROM city_year WHERE Country IN (SELECT Country FROM city_year GROUP BY Country ORDER BY count(*) DESC, Country LIMIT 15) GROUP BY 1",
    ),
)
def box_summary(spark, d):
    return rounded(P.box_summary(durable(city_temps(spark, d)), "Country", "AvgYearlyTemp", 15), "min", "q1", "median", "q3", "max")
