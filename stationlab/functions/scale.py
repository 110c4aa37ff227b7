"""Stored intermediate tables below the session's shared folder."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

_FOLDERS: dict[str, object] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else ``spark.sql.warehouse.dir``.

    Only read, never set. Below it the application has a folder of its own, removed when Python ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    home = f"{base.rstrip('/')}/stationlab-{spark.sparkContext.applicationId}"
    if home not in _FOLDERS:
        path = spark._jvm.org.apache.hadoop.fs.Path(home)
        _FOLDERS[home] = (path, path.getFileSystem(spark._jsc.hadoopConfiguration()))
    return home


def _remove_all():
    for path, fs in _FOLDERS.values():
        with contextlib.suppress(Exception):  # the JVM may be gone already
            fs.delete(path, True)


atexit.register(_remove_all)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Remove a path that :func:`scratch_path` gave."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def durable(df: DataFrame) -> DataFrame:
    """Store the rows below the shared folder and go on from the stored table.

    Later plans read it back: nothing upstream is recomputed, a lost executor costs nothing, and
    the optimizer knows the real size. It broadcasts the table when that is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
    """
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
