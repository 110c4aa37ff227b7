"""The items of largest inner product for every user, without scoring all pairs."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from .indexing import number_rows
from .scale import durable

# executors need numpy and pyarrow, but not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Items of a block, and users that are scored at once.
ITEM_BLOCK, USER_BLOCK = 65_536, 256


def _with_block(ids: np.ndarray, factors: np.ndarray, n: int, further: float):
    """Best items of users after one more block of items; ``open`` while an item of norm ``further`` could still enter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            users = np.stack(batch.column(1).to_pylist()).astype(np.float64)
            items, scores = [], []
            for lo in range(0, len(users), USER_BLOCK):  # bounds the score matrix
                part = users[lo : lo + USER_BLOCK] @ factors.T
                held_items, held_scores = (batch.column(k).slice(lo, USER_BLOCK).to_pylist() for k in (2, 3))
                for row, i, s in zip(part, held_items, held_scores, strict=True):
                    near = np.flatnonzero(row >= np.partition(row, -n)[-n]) if len(row) > n else np.arange(len(row))
                    i, s = np.r_[np.array(i, np.int64), ids[near]], np.r_[np.array(s, float), row[near]]
                    best = np.lexsort((i, -s))[:n]  # ties: the smaller item
                    items.append(i[best])
                    scores.append(s[best])
            least = np.array([s[-1] if len(s) == n else -np.inf for s in scores])
            still = np.linalg.norm(users, axis=1) * further * (1 + 1e-9) >= least
            lists = [pa.array(items, pa.list_(pa.int32())), pa.array(scores, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists, pa.array(still)], ["user", "factor", "items", "scores", "open"])

    return run


def top_items(users: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """``(user, item, score)``: the ``n`` items of largest inner product for each of ``users(id, features)``; ties by item.

    Items ``(id, features)`` come in blocks of falling norm. No later item can score beyond the user's norm times the
    next block's largest norm, so a user is done once that lies below the worst of its best items. A round sends one
    block, bounded by ``ITEM_BLOCK``, to the users that are still open; most close within the first rounds.
    """
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    ranked = number_rows(items.select(F.col("id").cast("int").alias("id"), "features", norm.alias("norm")), [F.desc("norm"), F.col("id")], "_row")
    count = ranked.count()
    empty = [F.array().cast("array<int>").alias("items"), F.array().cast("array<double>").alias("scores"), F.lit(True).alias("open")]
    open_ = durable(users.select(F.col("id").cast("int").alias("user"), F.col("features").cast("array<float>").alias("factor"), *empty))
    schema, done = open_.schema, []
    for lo in range(0, count, ITEM_BLOCK):
        block = ranked.filter(F.col("_row").between(lo, lo + ITEM_BLOCK)).orderBy("_row").toPandas()
        further = float(block["norm"].iloc[ITEM_BLOCK]) if len(block) > ITEM_BLOCK else -1.0
        block = block.iloc[:ITEM_BLOCK]
        factors = np.stack(block["features"].to_numpy()).astype(np.float64)
        now = durable(open_.mapInArrow(_with_block(block["id"].to_numpy(np.int64), factors, n, further), schema))
        done.append(now.filter("NOT open"))
        open_ = now.filter("open")
        if open_.isEmpty():
            break
    best = reduce(DataFrame.union, done, open_)
    return best.select("user", F.inline(F.arrays_zip(F.col("items").alias("item"), F.col("scores").alias("score"))))
