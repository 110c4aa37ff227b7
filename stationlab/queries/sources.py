"""Scans, sinks, layers and shapes."""

from pyspark.sql import functions as F

from .. import sources as S
from ..functions.scale import scratch_path
from .registry import METRICS, R, STATIONS, WIDE_COLUMNS, city_year, day, query, r8, rounded, station_long, station_wide, table, with_views


def _orders_text(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority"
    )


ORDERS_SCHEMA = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string"
ROUND_TRIP = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
  o_orderpriority FROM orders"""


def _schema(text):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(text)


@query("read_csv_table", ROUND_TRIP)
def read_csv_table(spark, d):
    path = scratch_path(spark, "csv")
    _orders_text(spark, d).write.option("header", True).csv(path)
    return S.read_csv_table(spark, path, _schema(ORDERS_SCHEMA)).withColumn("o_orderdate", day("o_orderdate"))


@query("read_json_table", ROUND_TRIP)
def read_json_table(spark, d):
    path = scratch_path(spark, "json")
    _orders_text(spark, d).write.json(path)
    return S.read_json_table(spark, path, _schema(ORDERS_SCHEMA)).withColumn("o_orderdate", day("o_orderdate"))


@query(
    "cast_numeric",
    """SELECT o_orderkey, TRY_CAST(CASE o_orderstatus WHEN 'P' THEN 'n/a' WHEN 'O' THEN '' ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE) AS price,
      TRY_CAST(o_orderpriority AS DOUBLE) AS priority, CAST(o_custkey AS DOUBLE) AS cust FROM orders""",
)
def cast_numeric(spark, d):
    status = F.col("o_orderstatus")
    text = table(spark, d, "orders").select(
        "o_orderkey",
        F.when(status == "P", "n/a").when(status == "O", "").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_custkey").cast("string").alias("cust"),
    )
    return S.cast_numeric(text, ["price", "priority", "cust"])


@query(
    "parse_date",
    """SELECT o_orderkey, CAST(CAST(try_strptime(CASE o_orderstatus WHEN 'P' THEN 'bad' WHEN 'O' THEN strftime(o_orderdate, '%Y%m') || '99'
      ELSE strftime(o_orderdate, '%Y%m%d') END, '%Y%m%d') AS DATE) AS VARCHAR) AS d FROM orders""",
)
def parse_date(spark, d):
    status = F.col("o_orderstatus")
    text = (
        F.when(status == "P", F.lit("bad"))
        .when(status == "O", F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("99")))
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    )
    return table(spark, d, "orders").select("o_orderkey", day(S.parse_date(text)).alias("d"))


@query(
    "date_parts",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS YEAR, CAST(month(o_orderdate) AS INTEGER) AS MONTH_NUM, CAST(day(o_orderdate) AS INTEGER) AS DAY FROM orders",
)
def date_parts(spark, d):
    return S.date_parts(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


def _round_trip(spark, d):
    path = scratch_path(spark, "layer")
    cy = city_year(spark, d)
    S.write_layer(cy.filter("Year < 1998"), path, "overwrite", "Country")
    S.write_layer(cy.filter("Year >= 1998"), path, "append", "Country")
    return S.read_layer(spark, path)


@query(
    "write_layer",
    with_views("city_year", f"SELECT Country, count(*) AS n, {R('sum(AvgYearlyTemp)')} AS total FROM city_year GROUP BY 1"),
)
def write_layer(spark, d):
    return _round_trip(spark, d).groupBy("Country").agg(F.count("*").alias("n"), r8(F.sum("AvgYearlyTemp")).alias("total"))


@query("read_layer", with_views("city_year", f"SELECT Country, City, Year, AvgYearlyTemp, PrevTemp, {R('TempChange')} AS TempChange FROM city_year"))
def read_layer(spark, d):
    return rounded(_round_trip(spark, d).select("Country", "City", "Year", "AvgYearlyTemp", "PrevTemp", "TempChange"), "TempChange")


def _layers(spark, d):
    root = scratch_path(spark, "layers")
    S.write_layer(table(spark, d, "orders"), S.layer_path(root, "bronze", "orders"))
    S.write_layer(table(spark, d, "customer"), S.layer_path(root, "silver", "customer"))
    S.write_layer(city_year(spark, d), S.layer_path(root, "gold", "city_year"), partition_by="Country")
    return root


@query(
    "layer_inventory",
    with_views(
        "city_year",
        """SELECT 'bronze' AS layer, 'orders' AS name, count(*) AS rows, 6 AS columns FROM orders
        UNION ALL SELECT 'silver', 'customer', count(*), 5 FROM customer
        UNION ALL SELECT 'gold', 'city_year', count(*), 6 FROM city_year""",
    ),
)
def layer_inventory(spark, d):
    return S.layer_inventory(spark, _layers(spark, d))


@query(
    "sql_query",
    f"""SELECT c_mktsegment AS segment, 'gold.' || o_orderstatus AS status, count(*) AS n, {R('sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 1e2')} AS total
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
)
def sql_query(spark, d):
    S.register_layers(spark, _layers(spark, d))
    return S.sql_query(
        spark,
        """SELECT c_mktsegment AS segment, 'gold.' || o_orderstatus AS status, count(*) AS n,
        round(sum(CAST(round(o_totalprice * 100) AS BIGINT)) / 1e2D + 3e-10D, 8) AS total
        FROM bronze_orders JOIN silver_customer ON o_custkey = c_custkey GROUP BY 1, 2""",
    )


@query("preview_rows", with_views("city_year", "SELECT Country, City, Year, AvgYearlyTemp FROM city_year ORDER BY Country, City, Year LIMIT 100"))
def preview_rows(spark, d):
    return S.preview_rows(city_year(spark, d).select("Country", "City", "Year", "AvgYearlyTemp"), ["Country", "City", "Year"], 100)


@query("distinct_values", with_views("city_temps", "SELECT DISTINCT City FROM city_temps"))
def distinct_values(spark, d):
    return S.distinct_values(city_year(spark, d), "City")


@query("station_catalog", with_views("station_long", "SELECT station, metric, count(value) AS n FROM station_long GROUP BY 1, 2"))
def station_catalog(spark, d):
    wide = station_wide(spark, d)
    counts = S.melt_stations(wide, ["DATE_PARSED"], drop_null=True).groupBy("station", "metric").agg(F.count("*").alias("n"))
    return S.station_catalog(wide, ["DATE_PARSED"]).join(counts, ["station", "metric"])


_UNPIVOT = " UNION ALL ".join(
    f"SELECT CAST(DATE_PARSED AS VARCHAR) AS d, '{s}' AS station, '{m}' AS metric, {s}_{m} AS value FROM station_wide" for s in STATIONS for m in METRICS
)


@query("melt_stations", with_views("station_wide", _UNPIVOT))
def melt_stations(spark, d):
    return S.melt_stations(station_wide(spark, d), ["DATE_PARSED"]).select(day("DATE_PARSED").alias("d"), "station", "metric", "value")


@query("widen_stations", with_views("station_wide", f"SELECT CAST(DATE_PARSED AS VARCHAR) AS d, {', '.join(WIDE_COLUMNS)} FROM station_wide"))
def widen_stations(spark, d):
    pairs = [(s, m) for s in STATIONS for m in METRICS]
    return S.widen_stations(station_long(spark, d), ["d"], pairs).withColumn("d", day("d"))
