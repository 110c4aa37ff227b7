"""Table scans, column typing and layer storage."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

CITY_SCHEMA = T.StructType(
    [
        T.StructField("Country", T.StringType()),
        T.StructField("City", T.StringType()),
        T.StructField("Year", T.IntegerType()),
        T.StructField("AvgYearlyTemp", T.DoubleType()),
        T.StructField("PrevTemp", T.DoubleType()),
        T.StructField("TempChange", T.DoubleType()),
    ]
)

STATION_ID_COLUMNS = ("DATE", "DATE_PARSED", "MONTH", "YEAR", "MONTH_NUM", "DAY")


def read_csv_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """CSV with a header line. Without a schema every column is text, as written.

    Bad cells become NULL (``PERMISSIVE``); no inference pass over the data.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("inferSchema", False)
    df = (reader.schema(schema) if schema is not None else reader).csv(path)
    return df.select(*columns) if columns else df


def read_json_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Line-delimited JSON under a given schema (no inference pass)."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def cast_numeric(df: DataFrame, columns: Iterable[str], to: str = "double") -> DataFrame:
    """Cast text columns to a number; text that is no number becomes NULL."""
    names = set(columns)
    return df.select(*[F.col(f"`{c}`").try_cast(to).alias(c) if c in names else F.col(f"`{c}`") for c in df.columns])


def parse_date(c: Column, fmt: str = "yyyyMMdd") -> Column:
    """Text to date; NULL for NULL or text that is no such date."""
    return F.try_to_date(c, fmt)


def date_parts(df: DataFrame, date_col: str, names: tuple[str, str, str] = ("YEAR", "MONTH_NUM", "DAY")) -> DataFrame:
    c = F.col(date_col)
    return df.withColumns({names[0]: F.year(c), names[1]: F.month(c), names[2]: F.dayofmonth(c)})


def load_station_table(spark: SparkSession, path: str) -> DataFrame:
    """The wide daily station CSV, typed: dates parsed, date parts added, all measures double."""
    raw = read_csv_table(spark, path)
    dated = date_parts(raw.withColumn("DATE_PARSED", parse_date(F.col("DATE"))), "DATE_PARSED")
    return cast_numeric(dated, [c for c in raw.columns if c not in STATION_ID_COLUMNS])


def load_city_table(spark: SparkSession, path: str) -> DataFrame:
    """The long yearly city CSV, typed; bad numbers become NULL."""
    raw = read_csv_table(spark, path)
    typed = cast_numeric(cast_numeric(raw, ["Year"], "int"), ["AvgYearlyTemp", "PrevTemp", "TempChange"])
    return typed.select(*CITY_SCHEMA.names)


def write_layer(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] | str | None = None,
    fmt: str = "parquet",
) -> None:
    """Store a table, optionally in one folder per partition value.

    With ``partition_by`` the rows are rebalanced on those columns first: adaptive execution then
    merges small values into one file and splits a value that holds a large share of the rows.
    """
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    writer = (df.hint("rebalance", *[F.col(p) for p in parts]) if parts else df).write.format(fmt).mode(mode)
    (writer.partitionBy(*parts) if parts else writer).save(path)


def read_layer(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Load a stored table; raises when it is not there."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)
