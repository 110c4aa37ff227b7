"""Experiment log as three append-only tables: runs, params, metrics."""

from __future__ import annotations

import datetime
import numbers
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import read_layer, write_layer

SCHEMAS = {
    "runs": "run_id string, experiment string, started timestamp, status string",
    "params": "run_id string, key string, value string",
    "metrics": "run_id string, key string, value double, step long, ts timestamp",
}


def log_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_layer(spark, f"{root.rstrip('/')}/{name}")


def append_runs(root: str, runs: DataFrame, params: DataFrame, metrics: DataFrame) -> None:
    """Append many runs at once. The run rows go last: a run is listed once its parts are stored."""
    for name, df in (("params", params), ("metrics", metrics), ("runs", runs)):
        write_layer(df, f"{root.rstrip('/')}/{name}", mode="append")


def log_experiment(
    spark: SparkSession,
    root: str,
    experiment: str,
    model_info: Mapping[str, object],
    params: Mapping[str, object],
    metrics: Mapping[str, object],
    step: int = 0,
    status: str = "FINISHED",
) -> str:
    """Append one run; model info becomes ``info_`` parameters, only numeric metrics are kept."""
    run = uuid.uuid4().hex
    now = datetime.datetime.now(datetime.timezone.utc)
    pairs = [(run, k, str(v)) for k, v in params.items()] + [(run, f"info_{k}", str(v)) for k, v in model_info.items()]
    numbers_only = [
        (run, k, float(v), step, now) for k, v in metrics.items() if isinstance(v, numbers.Real) and not isinstance(v, bool)
    ]
    append_runs(
        root,
        spark.createDataFrame([(run, experiment, now, status)], SCHEMAS["runs"]),
        spark.createDataFrame(pairs, SCHEMAS["params"]),
        spark.createDataFrame(numbers_only, SCHEMAS["metrics"]),
    )
    return run


def last_metrics(metrics: DataFrame) -> DataFrame:
    """The last value of each metric of each run, by time, then step."""
    return metrics.groupBy("run_id", "key").agg(F.max_by("value", F.struct("ts", "step")).alias("value"))


def last_params(params: DataFrame) -> DataFrame:
    """One value of each parameter of each run. Parameters carry no time, so of several values the largest text is taken."""
    return params.groupBy("run_id", "key").agg(F.max("value").alias("value"))


def run_details(runs: DataFrame, params: DataFrame, metrics: DataFrame) -> DataFrame:
    """Each run with maps ``params`` and ``metrics`` (last values); runs without them stay."""
    p = last_params(params).groupBy("run_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("params"))
    m = last_metrics(metrics).groupBy("run_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("metrics")
    )
    return runs.join(p, "run_id", "left").join(m, "run_id", "left")


def experiment_summary(
    runs: DataFrame,
    params: DataFrame,
    metrics: DataFrame,
    experiment: str | None = None,
    param_keys: Sequence[str] = (),
    metric_keys: Sequence[str] = (),
    as_maps: bool = False,
) -> DataFrame:
    """Without a name: runs per experiment. With one: a flat row per run, ``param_*`` and ``metric_*``.

    The keys may be named; otherwise they are looked up in the log first. ``as_maps`` gives ``params`` and ``metrics`` as
    maps instead: a log may hold any number of keys, and then none of them passes through the driver.
    """
    if experiment is None:
        return runs.groupBy("experiment").agg(F.count("*").alias("runs"))
    mine = runs.filter(F.col("experiment") == experiment)
    ids = mine.select("run_id")
    p = last_params(params.join(ids, "run_id", "left_semi"))
    m = last_metrics(metrics.join(ids, "run_id", "left_semi"))

    def flat(df, keys, name):
        if as_maps:
            pairs = F.array_sort(F.collect_list(F.struct("key", "value")))
            return df.groupBy("run_id").agg(F.map_from_entries(pairs).alias(f"{name}s"))
        keys = keys or [r.key for r in log_keys(df).select("key").orderBy("key").collect()]
        cells = [F.max(F.when(F.col("key") == k, F.col("value"))).alias(f"{name}_{k}") for k in keys]
        return df.groupBy("run_id").agg(F.lit(None).alias("_none"), *cells).drop("_none")

    return mine.join(flat(p, param_keys, "param"), "run_id", "left").join(flat(m, metric_keys, "metric"), "run_id", "left")


def log_keys(df: DataFrame) -> DataFrame:
    """The keys of a log table with the number of runs that have them."""
    return df.groupBy("key").agg(F.count_distinct("run_id").alias("runs"))
