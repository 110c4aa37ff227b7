"""Dense integer ids and stable splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .scale import durable


def number_rows(df: DataFrame, order: Sequence[Column | str], name: str, parts: int | None = None) -> DataFrame:
    """Add ``name``: 0, 1, ... in the given order, sorted in ``parts`` ranges (default: as many as the sizes ask for).

    A range-partitioned sort numbers the rows inside each partition; the partition's start is the
    sum of the earlier partition sizes. One number per partition passes through the driver, so the
    rows may be as many as the cluster can sort. The sorted rows are stored first: both uses then
    see the same partitions, also after an executor is lost.
    """
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order) if parts else df.orderBy(*order)
    ordered = durable(ranged.select("*", F.spark_partition_id().alias("_part"), inside.alias("_at")))
    sizes = {r[0]: r[1] for r in ordered.groupBy("_part").count().collect()}
    starts = [0]
    for part in range(max(sizes, default=0)):
        starts.append(starts[-1] + sizes.get(part, 0))
    start = F.get(F.expr(f"array({', '.join(f'{n}L' for n in starts)})"), F.col("_part"))
    return ordered.withColumn(name, start + F.col("_at")).drop("_part", "_at")


def dense_index(df: DataFrame, cols: Sequence[str], name: str = "index", base: int = 0) -> DataFrame:
    """Distinct values of ``cols`` with ids ``base, base+1, ...`` in sort order."""
    cols = list(cols)
    ids = number_rows(df.select(*cols).na.drop(subset=cols).distinct(), cols, "_row")
    return ids.select(*cols, (F.col("_row") + F.lit(base)).cast("long").alias(name))


def bucket_of(keys: Sequence[Column | str], buckets: int = 100) -> Column:
    """A bucket number that depends on the key text only: the first 32 bits of its MD5."""
    text = F.concat_ws("|", *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys])
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % F.lit(buckets).cast("long"))


def hash_split(df: DataFrame, keys: Sequence[str], train_ratio: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Split by key hash: the same key always lands on the same side, however the rows are spread."""
    if not 0 < train_ratio < 1:
        raise ValueError("train_ratio must lie between 0 and 1")
    cut = F.lit(int(train_ratio * 2**32))
    b = bucket_of(keys, 2**32)
    return df.filter(b < cut), df.filter(b >= cut)
