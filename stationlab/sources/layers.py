"""Bronze, silver and gold tables below one root folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import read_layer

LAYERS = ("bronze", "silver", "gold")


def layer_path(root: str, layer: str, name: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return f"{root.rstrip('/')}/{layer}/{name}"


def stored_tables(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(layer, name) of every table folder, through the file system the root lives on."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for layer in LAYERS:
        path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{layer}")
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            found += [(layer, s.getPath().getName()) for s in fs.listStatus(path) if s.isDirectory()]
    return sorted(found)


def layer_inventory(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """One row (layer, name, rows, columns) per stored table. Counts come from file footers."""
    parts = []
    for layer, name in stored_tables(spark, root):
        df = read_layer(spark, layer_path(root, layer, name), fmt)
        parts.append(
            df.agg(F.count("*").alias("rows")).select(
                F.lit(layer).alias("layer"), F.lit(name).alias("name"), "rows", F.lit(len(df.columns)).alias("columns")
            )
        )
    if not parts:
        return spark.createDataFrame([], "layer string, name string, rows long, columns int")
    return reduce(DataFrame.unionByName, parts)


def register_layers(spark: SparkSession, root: str, fmt: str = "parquet") -> list[str]:
    """Register every stored table as the view ``<layer>_<name>``."""
    views = []
    for layer, name in stored_tables(spark, root):
        view = f"{layer}_{name}"
        read_layer(spark, layer_path(root, layer, name), fmt).createOrReplaceTempView(view)
        views.append(view)
    return views


def sql_query(spark: SparkSession, text: str, explain: bool = False) -> DataFrame:
    """Run Spark SQL over the registered views; ``explain`` prints the plan as well."""
    df = spark.sql(text)
    if explain:
        df.explain("formatted")
    return df
