"""What the corpus operators share: table access, row and text keys, joins with a checked side."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scale import discard, durable, scratch_path

#: A word: a run of anything but ASCII white space (space, tab, line feed, vertical tab, form feed, carriage return).
WORD = r"[^\x20\x09-\x0D]+"
#: Bits that a filter of keys has for each of them, and the most 64-bit words of a filter (4 MB).
FILTER_BITS, FILTER_WORDS = 32, 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_key(text: Column) -> Column:
    """16 bytes that stand for a text: its MD5. Equal texts share it; null counts as the empty text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def row_key(ident: Column, text: Column) -> Column:
    """16 bytes that stand for an id and a text together, nulls told apart from empty values."""
    parts = F.concat(
        F.coalesce(ident.cast("string"), F.lit("?")), F.when(text.isNull(), "|?").otherwise("|="), F.coalesce(text, F.lit(""))
    )
    return F.unhex(F.md5(parts))


def residue(ident: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(ident.cast("string"), F.lit(""))) % F.lit(n)


def join_small(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left", max_rows: int = 500_000, salts: int = 32) -> DataFrame:
    """Join a table with one that is expected, but not known, to be small.

    ``small`` should be stored: it is counted first. Up to ``max_rows`` rows it is broadcast. A larger one is
    copied ``salts`` times and joined on (keys, salt), so that a key with a third of ``big`` is spread over
    ``salts`` tasks; 1 is for keys that cannot be hot on their own. Keys are compared null-safe. ``how`` is inner, left, left_semi or left_anti.
    """
    s = small.select(*[F.col(c).alias(f"_on_{c}") if c in on else F.col(c) for c in small.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on]
    if small.limit(max_rows + 1).count() <= max_rows:
        b, s = big, F.broadcast(s)
    elif salts == 1:
        b = big
    else:
        b = big.withColumn("_salt", (F.rand(17) * salts).cast("int"))
        s = s.withColumn("_on_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        same.append(F.col("_salt") == F.col("_on_salt"))
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return b.join(s, cond, how).drop("_salt", "_on_salt", *[f"_on_{c}" for c in on])


def may_be_among(keys: DataFrame, name: str) -> Callable[[Column], Column]:
    """A test for keys: true for all of the stored column ``name`` and, by chance, for one in some thirty others.

    A filter with one bit set for a key, which enters as a scalar subquery. It is all that passes the driver: ``FILTER_WORDS``
    words at most whatever the number of keys; a fuller filter lets more others pass. A join of the rows that pass settles them.
    """
    words = min(FILTER_WORDS, max(1, FILTER_BITS * keys.count() // 64))

    def spot(key: Column) -> tuple[Column, Column]:
        # a filter's condition is worked out anew at each use of the hash, so there are two only
        h = F.xxhash64(key)
        return (F.shiftrightunsigned(h, 32) % F.lit(words)).cast("int"), h.bitwiseAND(63).cast("int")

    at, bit = spot(F.col(name))
    marked = keys.select(at.alias("at"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("mask"))
    none = keys.sparkSession.range(words).select(F.col("id").cast("int").alias("at"), F.lit(0).cast("long").alias("mask"))
    merged = marked.union(none).groupBy("at").agg(F.bit_or("mask").alias("mask"))
    held = durable(merged.agg(F.sort_array(F.collect_list(F.struct("at", "mask"))).alias("words")).select("words.mask")).scalar()

    def passes(key: Column) -> Column:
        at, bit = spot(key)
        return F.getbit(F.get(held, at), bit) == 1

    return passes


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Stores tables as ``durable`` does, and removes them at the end of the block.

    A collection on the driver then lets Spark remove the shuffle files of their plans, too.
    """
    paths: list[str] = []

    def store(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "passing")
        df.write.parquet(path)
        paths.append(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield store
    finally:
        for path in paths:
            discard(spark, path)
        release(spark)


def release(spark: SparkSession) -> None:
    """Have the driver drop plans that nothing refers to any more; Spark removes their shuffle files."""
    spark._jvm.System.gc()


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finalizer of MurmurHash3); wraps around on purpose."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
