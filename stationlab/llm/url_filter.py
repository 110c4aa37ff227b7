"""Url filters: rules for hosts and path beginnings, looked up in a cascade of Bloom filters.

A rule's key is its host followed by its path (``example.com/en/``). A url's candidate keys are its host's last labels with
its path's beginnings, for the numbers of labels and lengths of paths that rules have; no other key of the url can be a
rule, so the candidates of all urls are the corpus's whole key universe.

The first filter of a cascade holds the listed keys, the second the keys of the universe that pass the first without being
listed, the third the listed keys that pass the second, and so on until nothing passes that should not. A key that fails at
a filter is unlisted if the filter holds listed keys and listed otherwise: exact for every key of the universe, without a
join at lookup. Filters are built from partial masks that Spark merges word by word; a filter's size follows the number of
its keys (the rule list, then shrinking shares of rules and universe) and is checked before it reaches the driver.

Of several rules that fit, the longest key wins, then the longer host; a key listed both ways blocks. A url without a rule
gets the default verdict. A null url, or one without ``://``, has an empty host and path. Null hosts and paths of rules are
empty; rules with another verdict than allow and block are an error. Empty tables give no rows, repeated rows stay
repeated, further columns are ignored. A very long host or path is cut to the candidates, never compared whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scale import durable
from .common import mixed

#: Bits of a filter for each key, and probes of a key.
BITS, PROBES = 8, 5
#: A cascade that needs more bytes than this is not sent to tasks.
MAX_BYTES = 256 << 20
#: More levels mean that two keys share their hashes.
MAX_LEVELS = 64


@dataclass
class Cascade:
    """Filters as arrays of 64-bit words; those at even places hold listed keys."""

    levels: list[np.ndarray]

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out, at = np.zeros(len(h1), bool), np.arange(len(h1))
        for k, words in enumerate(self.levels):
            hit = _passes(words, k, h1[at], h2[at])
            if k % 2:
                out[at[~hit]] = True
            at = at[hit]
        if len(self.levels) % 2:
            out[at] = True
        return out


def _places(size: int, level: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """The bits of each key, one row a probe; every level mixes the hashes anew."""
    salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    a, b = mixed(h1.view(np.uint64) ^ salt), mixed(h2.view(np.uint64) + salt)
    return np.stack([mixed(a + np.uint64(i) * b) for i in range(PROBES)]) % np.uint64(size)


def _passes(words: np.ndarray, level: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    at = _places(64 * len(words), level, h1, h2)
    return ((words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)


def hashes_of(key: Column) -> tuple[Column, Column]:
    """128 bits that stand for a key."""
    return F.xxhash64(key), F.xxhash64(F.lit("|"), key)


def _filter_of(keys: DataFrame, n: int, level: int) -> np.ndarray:
    """A filter of the ``n`` rows of ``keys(h1, h2)``: tasks set bits of words, Spark merges the words."""
    words = max(1, -(-BITS * n // 64))
    if 8 * words > MAX_BYTES:
        raise ValueError(f"a filter of {8 * words} bytes is more than {MAX_BYTES}: split the rules and judge in turn")
    size = 64 * words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            at = np.unique(_places(size, level, h1, h2))
            word, first = np.unique((at >> np.uint64(6)).astype(np.int64), return_index=True)
            mask = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(mask.view(np.int64))], ["word", "mask"])

    merged = keys.select("h1", "h2").mapInArrow(run, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    out = np.zeros(words, np.uint64)
    out[merged["word"].to_numpy(np.int64)] = merged["mask"].to_numpy(np.int64).view(np.uint64)
    return out


def _passing(words: np.ndarray, level: int):
    @F.pandas_udf("boolean")
    def passes(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(_passes(words, level, h1.to_numpy(np.int64), h2.to_numpy(np.int64)))

    return passes


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """The cascade that tells the keys of ``listed(key)`` from all others of ``universe(key)``; both may have repeated keys."""

    def hashed(keys):
        h1, h2 = hashes_of(F.col("key"))
        return keys.select("key", h1.alias("h1"), h2.alias("h2"))

    held = durable(hashed(listed.select(F.coalesce("key", F.lit("")).alias("key")).distinct()))
    rest = hashed(universe.select("key").distinct()).join(held.select("key"), "key", "left_anti")
    levels, n = [], held.count()
    while n:
        k = len(levels)
        if k == MAX_LEVELS:
            raise ValueError("two keys share their hashes")
        words = _filter_of(held, n, k)
        levels.append(words)

        # what should fail here and does not is what the next filter holds
        held, rest = durable(rest.filter(_passing(words, k)("h1", "h2"))), held
        n = held.count()
    return Cascade(levels)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url; both empty if it is null or has no ``://``."""
    begin = F.instr(url, "://")
    rest = F.when(begin > 0, F.substring(url, begin + F.lit(3), F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def candidate_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys, longest first, that a url has for rules of ``shapes`` (labels of the host, length of the path)."""
    if not shapes:
        return F.array().cast("array<string>")
    shape = F.array(*[F.struct(F.lit(k).alias("labels"), F.lit(p).alias("length")) for k, p in shapes])
    n = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    fits = F.filter(shape, lambda s: (s["labels"] <= n) & (s["length"] <= F.length(path)))

    def key(s):
        end = F.call_function("substring_index", host, F.lit("."), -s["labels"])
        k = F.concat(end, F.substring(path, F.lit(1), s["length"]))
        return F.struct(F.length(k).alias("length"), F.length(end).alias("host"), k.alias("key"))

    return F.transform(F.sort_array(F.transform(fits, key), asc=False), lambda c: c["key"])


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``(id, host, path, rule, verdict)`` for every row of ``pages`` under ``rules(host, path, verdict)``."""
    host, path = F.coalesce("host", F.lit("")), F.coalesce("path", F.lit(""))
    listed = durable(
        rules.select(F.concat(host, path).alias("key"), F.size(F.split(host, r"\.", -1)).alias("labels"), F.length(path).alias("length"), F.col("verdict"))
    )
    if listed.filter("verdict is null or verdict not in ('allow', 'block')").limit(1).count():
        raise ValueError("verdicts are allow and block")
    shapes = sorted((r.labels, r.length) for r in listed.select("labels", "length").distinct().collect())
    h, p = host_and_path(F.col(url_col))
    cut = pages.select(F.col(id_col), h.alias("host"), p.alias("path"))
    keyed = cut.withColumn("_keys", candidate_keys(F.col("host"), F.col("path"), shapes))
    universe = durable(keyed.select(F.explode("_keys").alias("key")).distinct())
    block, allow = (build_cascade(listed.filter(F.col("verdict") == v), universe) for v in ("block", "allow"))

    @F.pandas_udf("int")
    def first(h1: pd.Series, h2: pd.Series) -> pd.Series:
        """The place of the first listed key, from 1, negative if it blocks; 0 if there is none."""
        n = np.fromiter(map(len, h1), np.int64, len(h1))
        if not n.sum():
            return pd.Series(np.zeros(len(h1), np.int32))
        a, b = (np.concatenate([np.asarray(x, np.int64) for x in h]) for h in (h1, h2))
        stop = block.listed(a, b)
        code = np.where(stop, -1, np.where(allow.listed(a, b), 1, 0)) * (np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + 1)
        row, hit = np.repeat(np.arange(len(n)), n), np.flatnonzero(code)
        out = np.zeros(len(n), np.int32)
        rows, at = np.unique(row[hit], return_index=True)
        out[rows] = code[hit[at]]
        return pd.Series(out)

    h1, h2 = F.transform("_keys", lambda k: hashes_of(k)[0]), F.transform("_keys", lambda k: hashes_of(k)[1])
    found = keyed.withColumn("_at", first(h1, h2))
    verdict = F.when(F.col("_at") < 0, "block").when(F.col("_at") > 0, "allow").otherwise(default)
    return found.select(id_col, "host", "path", F.get("_keys", F.abs("_at") - 1).alias("rule"), verdict.alias("verdict"))
