"""Query registry, shared views over the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the independent statement for the same answer."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        @wraps(fn)
        def run(spark, sf_dir):
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


DIGITS = 8
# Shifts exact decimal ties off the rounding edge, where summation order would decide them.
OFF_TIE = 3e-10


def r8(c: Column | str) -> Column:
    """Publish a number with eight decimals and without a negative zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double") + F.lit(OFF_TIE), DIGITS) + F.lit(0.0)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    text = f"round(CAST({{0}} AS DOUBLE) + {OFF_TIE!r}D, {DIGITS}) + 0D AS {{0}}"
    return df.selectExpr(*[text.format(f"`{c}`") if c in names else f"`{c}`" for c in df.columns])


def day(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def R(x: str) -> str:
    return f"(round(CAST({x} AS DOUBLE) + {OFF_TIE!r}, {DIGITS}) + 0e0)"


# -- Spark views --------------------------------------------------------------------------


def cents(c: str) -> Column:
    return F.sum(F.round(F.col(c) * 100).cast("long"))


def q4(c: Column) -> Column:
    return F.floor(c * 10000 + F.lit(0.5)) / F.lit(10000.0)


def _city(spark, d, period: Column, name: str) -> DataFrame:
    """Mean price of a supplier's lines per period, as a temperature.

    Lines are summed per supplier before the joins, so a supplier with many lines costs one row.
    """
    lines = table(spark, d, "lineitem").select("l_suppkey", period.alias(name), "l_extendedprice")
    small = lines.groupBy("l_suppkey", name).agg(cents("l_extendedprice").alias("c"), F.count("*").alias("n"))
    places = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    joined = small.join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.groupBy(F.col("n_name").alias("Country"), F.col("s_name").alias("City"), name).agg(
        q4(F.sum("c") / F.sum("n") / F.lit(100000.0) - F.lit(40.0)).alias("AvgYearlyTemp")
    )


def city_temps(spark, d) -> DataFrame:
    """Country, City, Year, AvgYearlyTemp."""
    return _city(spark, d, F.year("l_shipdate"), "Year")


def city_year(spark, d) -> DataFrame:
    """The yearly city table: city_temps with PrevTemp and TempChange."""
    from ..functions.windows import over_rows

    def change(w):
        prev = F.lag("AvgYearlyTemp").over(w)
        return {"PrevTemp": prev, "TempChange": F.col("AvgYearlyTemp") - prev}

    return over_rows(city_temps(spark, d), ["Country", "City"], "Year", [change], before=1)


def city_month(spark, d) -> DataFrame:
    """Country, City, month number since year 0, Temp."""
    index = F.year("l_shipdate") * 12 + F.month("l_shipdate") - 1
    return _city(spark, d, index, "mi").withColumnRenamed("AvgYearlyTemp", "Temp")


STATIONS = ("ST_1", "ST_2", "ST_3", "ST_4", "ST_5")
METRICS = ("temp_mean", "temp_min", "temp_max", "humidity", "precipitation")
WIDE_COLUMNS = [f"{s}_{m}" for s in STATIONS for m in METRICS]


def station_flat(spark, d) -> DataFrame:
    """One row per station and day, one column per metric."""
    o = table(spark, d, "orders").select(
        F.concat(F.lit("ST_"), F.left("o_orderpriority", F.lit(1))).alias("station"),
        F.col("o_orderdate").cast("date").alias("d"),
        "o_totalprice",
        "o_orderstatus",
    )
    paid = F.when(F.col("o_orderstatus") == "P", F.round(F.col("o_totalprice") * 100).cast("long"))
    million = F.lit(1000000.0)
    return o.groupBy("station", "d").agg(
        q4(cents("o_totalprice") / F.count("*") / million - 15).alias("temp_mean"),
        q4(F.min("o_totalprice") / F.lit(10000.0) - 15).alias("temp_min"),
        q4(F.max("o_totalprice") / F.lit(10000.0) - 15).alias("temp_max"),
        q4(F.count_if(F.col("o_orderstatus") == "F") / F.count("*")).alias("humidity"),
        q4(F.coalesce(F.sum(paid), F.lit(0)) / F.lit(10000000.0)).alias("precipitation"),
    )


def station_long(spark, d) -> DataFrame:
    cells = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS]
    return station_flat(spark, d).select("station", "d", F.inline(F.array(*cells)))


def station_wide(spark, d) -> DataFrame:
    """The wide daily table; NULL where a station has no order that day."""
    cells = [f"max(CASE WHEN station = '{s}' THEN {m} END) AS {s}_{m}" for s in STATIONS for m in METRICS]
    return station_flat(spark, d).groupBy(F.col("d").alias("DATE_PARSED")).agg(*[F.expr(c) for c in cells])


# -- SQL twins ----------------------------------------------------------------------------

_Q4 = "floor(({x}) * 1e4 + 0.5e0) / 1e4"


def sq4(x: str) -> str:
    return _Q4.format(x=x)


def _city_sql(period: str, name: str, value: str) -> str:
    body = sq4("sum(CAST(round(l_extendedprice * 100) AS BIGINT)) / count(*) / 1e5 - 40e0")
    return f"""SELECT n_name AS Country, s_name AS City, {period} AS {name}, {body} AS {value}
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    GROUP BY 1, 2, 3"""


_WIDE = ", ".join(f"max(CASE WHEN station = '{s}' THEN {m} END) AS {s}_{m}" for s in STATIONS for m in METRICS)

CTES = {
    "city_temps": (_city_sql("CAST(year(l_shipdate) AS INTEGER)", "Year", "AvgYearlyTemp"), []),
    "city_year": (
        """SELECT *, lag(AvgYearlyTemp) OVER w AS PrevTemp, AvgYearlyTemp - lag(AvgYearlyTemp) OVER w AS TempChange
    FROM city_temps WINDOW w AS (PARTITION BY Country, City ORDER BY Year)""",
        ["city_temps"],
    ),
    "city_month": (_city_sql("CAST(year(l_shipdate) * 12 + month(l_shipdate) - 1 AS INTEGER)", "mi", "Temp"), []),
    "station_flat": (
        f"""SELECT 'ST_' || left(o_orderpriority, 1) AS station, CAST(o_orderdate AS DATE) AS d,
      {sq4("sum(CAST(round(o_totalprice * 100) AS BIGINT)) / count(*) / 1e6 - 15")} AS temp_mean,
      {sq4("min(o_totalprice) / 1e4 - 15")} AS temp_min,
      {sq4("max(o_totalprice) / 1e4 - 15")} AS temp_max,
      {sq4("count(*) FILTER (o_orderstatus = 'F') / count(*)")} AS humidity,
      {sq4("coalesce(sum(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER (o_orderstatus = 'P'), 0) / 1e7")} AS precipitation
    FROM orders GROUP BY 1, 2""",
        [],
    ),
    "station_long": (
        " UNION ALL ".join(f"SELECT station, d, '{m}' AS metric, {m} AS value FROM station_flat" for m in METRICS),
        ["station_flat"],
    ),
    "station_wide": (f"SELECT d AS DATE_PARSED, {_WIDE} FROM station_flat GROUP BY d", ["station_flat"]),
}


def with_views(names: str, body: str, extra: str = "") -> str:
    """Prefix a statement with the views it names (and further CTE text)."""
    order: list[str] = []

    def add(n):
        for dep in CTES[n][1]:
            add(dep)
        if n not in order:
            order.append(n)

    for n in names.split():
        add(n)
    parts = [f"{n} AS MATERIALIZED (\n    {CTES[n][0]})" for n in order]
    if extra:
        parts.append(extra.strip().rstrip(","))
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def constant_checks(**expected: str) -> str:
    """SQL rows (check, value); each value is an expression over the tables or the required constant."""
    return " UNION ALL ".join(f"SELECT '{k}' AS \"check\", CAST(({v}) AS BIGINT) AS value" for k, v in expected.items())


def checks_frame(spark: SparkSession, **values) -> DataFrame:
    """Rows (check, value): counts from the model's own output, and violations of its invariants."""
    return spark.createDataFrame([(k, int(v)) for k, v in values.items()], "check string, value long")


def md5_bucket(*cols: str, buckets: int = 2**32) -> str:
    """SQL twin of the key-hash bucket."""
    text = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % {buckets})"
