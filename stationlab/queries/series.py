"""Time-series queries."""

from pyspark.sql import functions as F

from ..operators import series as T
from .registry import R, city_month, city_year, day, query, r8, rounded, station_flat, with_views

CITY = ["Country", "City"]


@query("series_extract", with_views("city_year", "SELECT Country, City, Year, AvgYearlyTemp FROM city_year WHERE Country IN (SELECT min(Country) FROM city_year UNION ALL SELECT max(Country) FROM city_year)"))
def series_extract(spark, d):
    cy = city_year(spark, d)
    low, high = cy.agg(F.min("Country"), F.max("Country")).first()
    return T.series_extract(cy, "Year", "AvgYearlyTemp", {"Country": [low, high]}, CITY)


@query(
    "rolling_stats",
    with_views(
        "city_month",
        f"""SELECT Country, City, mi, CASE WHEN count(Temp) OVER w = 10 THEN {R('avg(Temp) OVER w')} END AS rolling_mean,
        CASE WHEN count(Temp) OVER w = 10 THEN {R('stddev_samp(Temp) OVER w')} END AS rolling_std FROM city_month
        WINDOW w AS (PARTITION BY Country, City ORDER BY mi ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
    ),
)
def rolling_stats(spark, d):
    return rounded(T.rolling_stats(city_month(spark, d), CITY, "mi", "Temp", 10).drop("Temp"), "rolling_mean", "rolling_std")


@query("seasonality", with_views("station_flat", f"SELECT CAST(month(d) AS INTEGER) AS month, left(monthname(d), 3) AS month_name, {R('avg(temp_mean)')} AS mean FROM station_flat GROUP BY 1, 2"))
def seasonality(spark, d):
    return rounded(T.seasonality(station_flat(spark, d), F.month("d"), "temp_mean"), "mean")


@query(
    "autocorrelation",
    with_views(
        "city_month",
        f"""SELECT a.Country, a.City, CAST(b.n - a.n AS INTEGER) AS lag, {R('sum((a.Temp - a.m) * (b.Temp - b.m)) / any_value(a.ss)')} AS autocorrelation
        FROM z a JOIN z b ON a.Country = b.Country AND a.City = b.City AND b.n > a.n WHERE a.ss > 0 GROUP BY 1, 2, 3""",
        """y AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY Country, City ORDER BY mi) AS n, avg(Temp) OVER (PARTITION BY Country, City) AS m FROM city_month),
        z AS MATERIALIZED (SELECT *, sum((Temp - m) * (Temp - m)) OVER (PARTITION BY Country, City) AS ss FROM y)""",
    ),
)
def autocorrelation(spark, d):
    return rounded(T.autocorrelation(city_month(spark, d), CITY, "mi", "Temp"), "autocorrelation")


@query(
    "seasonal_decompose",
    with_views(
        "city_month",
        f"""SELECT t.Country, t.City, mi, Temp, {R('trend')} AS trend, {R('s')} AS seasonal, {R('Temp - trend - s')} AS residual
        FROM t JOIN p ON t.Country = p.Country AND t.City = p.City AND t.mi % 12 = p.phase""",
        """t AS MATERIALIZED (SELECT *, CASE WHEN count(*) OVER (PARTITION BY Country, City ORDER BY mi ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) = 13 THEN
          (avg(Temp) OVER (PARTITION BY Country, City ORDER BY mi ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)
           + avg(Temp) OVER (PARTITION BY Country, City ORDER BY mi ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING)) / 2 END AS trend FROM city_month),
        g AS MATERIALIZED (SELECT Country, City, mi % 12 AS phase, avg(Temp - trend) AS a FROM t GROUP BY 1, 2, 3),
        p AS MATERIALIZED (SELECT Country, City, phase, a - avg(a) OVER (PARTITION BY Country, City) AS s FROM g)""",
    ),
)
def seasonal_decompose(spark, d):
    out = T.seasonal_decompose(city_month(spark, d), CITY, "mi", "Temp", F.col("mi") % 12)
    return rounded(out, "trend", "seasonal", "residual")
