"""Windows over time series that stay bounded when one series is very long.

A window partitioned by the series key alone puts a whole series into one task. Here the
partition is (key, chunk): a chunk is a stretch of row numbers for frames given in rows, a stretch
of time for frames given by distance. Rows a frame needs from other chunks are copied in as
*halo* rows, and dropped after the window ran, so the answer equals the plain window.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F, types as T

from .indexing import number_rows

CHUNK, HALO, ROW = "_chunk", "_halo", "_row"

ROWS_PER_CHUNK = 4096
DAYS_PER_CHUNK = 1024
STEPS_PER_CHUNK = 256
SECONDS_PER_CHUNK = 7 * 86400

Stage = Callable[[WindowSpec], Mapping[str, Column]]


def position(df: DataFrame, time_col: str) -> Column:
    """The time column as a whole number: days, seconds or the number itself."""
    t = df.schema[time_col].dataType
    c = F.col(time_col)
    if isinstance(t, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(t, T.TimestampType):
        return F.unix_seconds(c)
    if isinstance(t, T.TimestampNTZType):
        return F.unix_seconds(F.to_timestamp_ltz(c))
    if isinstance(t, T.NumericType):
        return F.floor(c).cast("long")
    raise ValueError(f"{time_col} is not a date, timestamp or number")


def default_chunk(df: DataFrame, time_col: str) -> int:
    """Width of a chunk of time."""
    t = df.schema[time_col].dataType
    if isinstance(t, T.DateType):
        return DAYS_PER_CHUNK
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return SECONDS_PER_CHUNK
    return STEPS_PER_CHUNK


def row_halo(
    df: DataFrame, keys: Sequence[str], time_col: str, before: int = 0, after: int = 0, chunk: int | None = None
) -> DataFrame:
    """Add ``_row``, ``_chunk`` and ``_halo``; each chunk also holds the ``before`` rows that precede it
    and the ``after`` rows that follow it.

    Rows are numbered in the order of keys and time (ties by a hash of the row), and ``chunk`` numbers
    make a chunk, so chunks are equal however many rows a series or a moment has. By default a chunk
    is at least four times its halo, which bounds the copies to a quarter of the rows.
    """
    size = max(chunk or max(ROWS_PER_CHUNK, 4 * (before + after)), 1)
    hashed = [c.name for c in df.schema if not isinstance(c.dataType, (T.MapType, T.VariantType))]
    order = [*[F.col(k) for k in keys], F.col(time_col).asc_nulls_first(), F.xxhash64(*hashed)]

    def at(row: Column) -> Column:
        return F.floor(row / F.lit(size)).cast("long")

    row = F.col(ROW)
    chunks = F.sequence(at(F.greatest(row - after, F.lit(0))), at(row + before))
    # all ranges are kept, so that what follows the stored rows is spread as widely as a shuffle
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return number_rows(df, order, ROW, parts).withColumn(CHUNK, F.explode(chunks)).withColumn(HALO, F.col(CHUNK) != at(row))


def range_halo(df: DataFrame, keys: Sequence[str], time_col: str, span: int, chunk: int | None = None) -> DataFrame:
    """For frames given by distance, chunks of time: rows within ``span`` of a chunk are copied to it."""
    size = max(chunk or default_chunk(df, time_col), 1)
    pos = position(df, time_col)

    def at(p: Column) -> Column:
        return F.floor(p / F.lit(size)).cast("long")

    return df.withColumn(CHUNK, F.explode_outer(F.sequence(at(pos - span), at(pos + span)))).withColumn(
        HALO, ~F.col(CHUNK).eqNullSafe(at(pos))
    )


def over_rows(
    df: DataFrame,
    keys: Sequence[str],
    time_col: str,
    stages: Sequence[Stage],
    before: int = 0,
    after: int = 0,
    chunk: int | None = None,
) -> DataFrame:
    """Run window stages whose frames look ``before`` rows back and ``after`` rows ahead in all.

    ``stages`` are applied in turn; each gets the ordered window and returns new columns, so a
    later stage may look at the columns of an earlier one.
    """
    out = row_halo(df, keys, time_col, before, after, chunk)
    w = Window.partitionBy(*keys, CHUNK).orderBy(ROW)
    for stage in stages:
        out = out.withColumns(dict(stage(w)))
    return out.filter(~F.col(HALO)).drop(CHUNK, HALO, ROW)


def over_range(
    df: DataFrame, keys: Sequence[str], time_col: str, stage: Stage, span: int, chunk: int | None = None
) -> DataFrame:
    """Run one stage over the frame ``[t - span, t + span]``."""
    out = range_halo(df, keys, time_col, span, chunk)
    w = Window.partitionBy(*keys, CHUNK).orderBy(position(df, time_col)).rangeBetween(-span, span)
    return out.withColumns(dict(stage(w))).filter(~F.col(HALO)).drop(CHUNK, HALO)
