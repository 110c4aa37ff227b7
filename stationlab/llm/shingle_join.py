"""Texts whose word shingles have a Jaccard similarity of at least a threshold, without missing any.

Shingles are brought into one order for all texts. Of two sets that are similar enough, the first ``n - ceil(t n) + 1``
shingles of each have one in common (prefix filter), so only these are filed. Shingles that a sample finds in several texts
come last in the order; this changes the amount of work, never the links.

The smallest text of a cell is its lead. First each text is compared with one lead, the one it shares most cells with, and
links that another method proposes are checked: that brings a group of near copies together by as many comparisons as it has
texts. Of the cells then only those rows go on that sizes, places and components let fit another row. Next comes a smallest
spanning forest of each cell (of each ``PIECE`` rows of a larger one) by the distance of parity sketches, which joins a group
without a common lead by fewer comparisons than its texts have cells, and at last all texts of a cell that are still apart.
From the forest on, a pair is only checked if its parity sketches allow it: a bit of a sketch is the parity of the shingles
dealt to it, so two sketches differ in at most as many bits as the sets in shingles, and no similar pair is left out. Each
pair is checked by its whole sets, so the components are those of all pairs of similar texts. Tables of a step go with the step.

A text stands for itself by 64 bits, a shingle too. Null, empty and blank texts are equal to each other; a text of fewer
words than a shingle has one shingle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scale import durable
from .common import join_small, may_be_among, passing, release
from .components import connected_components

#: One text of SAMPLE tells which shingles are common; about COMMON of them at most are put last.
SAMPLE, COMMON = 16, 100_000
#: A text in more pairs than this is dealt to SALTS tasks; so many such texts at most are sent to all tasks.
HOT, SALTS, FEW = 512, 64, 20_000
#: Rows that leave a task at once, and texts a task remembers to skip their copies.
LOT, SEEN = 50_000, 200_000
#: Longs of a parity sketch; rows of a cell that are compared at once, and that a task holds to see their components.
SKETCH, PIECE, HELD = 8, 256, 100_000
CELLS = "token long, key long, n int, at int, lead long, lead_n int, lead_at int, near boolean"
OPEN = "token long, key long, n int, at int, root long"


def key_of(text: Column) -> Column:
    """64 bits that stand for a text; null counts as the empty text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def shingles(text, size: int = 5) -> np.ndarray:
    """The different shingles of a text, hashed and sorted; words as in simhash."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []
    if not words:
        return np.zeros(1, np.uint64)
    h64 = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([h64(b" ".join(words), 42)], np.uint64)
    joined = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    return np.unique(np.fromiter((h64(s, 42) for s in joined), np.uint64, len(words) - size + 1))


def _needed(n, m, t: float):
    """Shared shingles that sets of ``n`` and ``m`` need."""
    return np.ceil(t / (1 + t) * (n + m) - 1e-6)


def _filed(texts: DataFrame, size: int, t: float, common: np.ndarray) -> DataFrame:
    """``(token, key, n, at)``: the first shingles of each text in the common order, with their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, parts, held = set(), [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], ["token", "key", "n", "at"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if key in seen:
                    continue
                if len(seen) == SEEN:
                    seen.clear()
                seen.add(key)
                s = shingles(text.as_py(), size)
                n = len(s)
                if len(common):
                    # ranks rise with the count; all others have rank 0
                    order, rank = common
                    place = np.minimum(np.searchsorted(order, s), len(order) - 1)
                    s = s[np.lexsort((s, np.where(order[place] == s, rank[place], 0)))]
                p = n - math.ceil(t * n - 1e-6) + 1
                parts.append((s[:p].view(np.int64), np.full(p, key, np.int64), np.full(p, n, np.int32), np.arange(p, dtype=np.int32)))
                held += p
                if held >= LOT:
                    yield out()
                    parts, held = [], 0
        if parts:
            yield out()

    return texts.mapInArrow(run, "token long, key long, n int, at int")


def _common(texts: DataFrame, size: int) -> np.ndarray:
    """Shingles (sorted) of three or more texts of the sample, with ranks that rise with the count."""

    def run(batches):
        for batch in batches:
            for text in batch.column(1):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(text.as_py(), size).view(np.int64))], ["token"])

    drawn = texts.filter(F.pmod(F.col("key"), F.lit(SAMPLE)) == 0).dropDuplicates(["key"])
    with passing(texts.sparkSession) as store:
        counts = store(drawn.mapInArrow(run, "token long").groupBy("token").count().filter("count > 2"))
        # the cut comes from the numbers of shingles by count: a sort with a limit would send COMMON rows of each task to the driver
        least, cut, room = 3, None, COMMON
        for many, n in counts.groupBy("count").agg(F.count("*").alias("n")).sort(F.desc("count")).collect():
            if n > room:
                # hashes are even, so a stretch of them has its share of the shingles of this count
                least, cut = many, int(room / n * 2**64) - 2**63
                break
            room -= n
        taken = F.col("count") >= least
        top = counts.filter(taken if cut is None else taken & ((F.col("count") > least) | (F.col("token") < cut))).toArrow()
    if not top.num_rows:
        return np.zeros((0, 0), np.uint64)
    token, count = (top[c].to_numpy() for c in ("token", "count"))
    rank = np.empty(len(token), np.uint64)
    rank[np.lexsort((token, -count))] = np.arange(len(token), 0, -1)
    token = token.view(np.uint64)
    order = np.argsort(token)
    return np.stack([token[order], rank[order]])


def _cells(t: float):
    """Rows sorted by (token, n, key) to the texts of each cell with two or more, beside the first, which comes as its own lead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None  # of the cell that may go on: (token, key, n, at) and the key that came last
        given = False  # whether its first text was returned
        for batch in batches:
            token, key, n, at = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            if not len(token):
                continue
            new = np.r_[first is None or token[0] != first[0], token[1:] != token[:-1]]
            start = np.flatnonzero(new)
            of = np.cumsum(new)  # 0: the cell of the batch before
            old = first or (0, 0, 0, 0)
            lead, lead_n, lead_at = (np.r_[o, c[start]][of] for o, c in zip(old[1:], (key, n, at), strict=True))
            again = np.r_[not new[0] and key[0] == last, (key[1:] == key[:-1]) & ~new[1:]]
            k = np.flatnonzero(~new & ~again & (key != lead))
            cells = np.unique(of[k])
            fresh = cells[cells > 0] if given else cells
            own = [np.r_[o, c[start]][fresh] for o, c in zip(old, (token, key, n, at), strict=True)]
            given = bool((cells == of[-1]).any()) or (given and not len(start))
            if len(start):
                s = start[-1]
                first = (token[s], key[s], n[s], at[s])
            last = key[-1]
            if len(k):
                room = np.minimum(n[k] - at[k], lead_n[k] - lead_at[k])
                near = (lead_n[k] >= t * n[k] - 1e-6) & (room >= _needed(n[k], lead_n[k], t))
                rows = [np.r_[c[k], o] for c, o in zip((token, key, n, at, lead, lead_n, lead_at), [*own, *own[1:]], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.astype(d)) for c, d in zip(rows, ("i8", "i8", "i4", "i4", "i8", "i4", "i4"), strict=True)] + [pa.array(np.r_[near, np.zeros(len(fresh), bool)])],
                    ["token", "key", "n", "at", "lead", "lead_n", "lead_at", "near"],
                )

    return run


def _whole_cells(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[bool, list[np.ndarray]]]:
    """Columns of rows sorted by their first, cut between its values; more than ``most`` rows of a value are cut, too, and told by False."""
    held, cut = None, None
    for batch in batches:
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(batch.num_columns)]
        if held is not None:
            cols = [np.concatenate(c) for c in zip(held, cols, strict=True)]
        while len(cols[0]):
            token = cols[0]
            # of the first cell if it was cut before, then of all cells but the last, then of the last if it is too long
            if token[0] == cut and token[-1] != cut:
                k, whole = int(np.argmax(token != cut)), False
            elif token[0] != token[-1]:
                k, whole = int(np.argmax(token == token[-1])), True
            elif len(token) > most:
                k, whole, cut = most, False, token[0]
            else:
                break
            yield whole, [c[:k] for c in cols]
            cols = [c[k:] for c in cols]
        held = cols
    if held is not None and len(held[0]):
        yield held[0][0] != cut, held


def _fitting(cols: list[np.ndarray], t: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places of rows (token, key, n, at, root, ...) in one cell that sizes, places and components allow; by distance."""
    token, key, n, at, root = cols[:5]
    stop = np.r_[np.flatnonzero(token[1:] != token[:-1]) + 1, len(token)]
    end = np.repeat(stop, np.diff(np.r_[0, stop]))
    i, d = np.arange(len(token)), 1
    while True:
        # sizes rise inside a cell, so a row whose partner is too long is done
        i = i[i + d < end[i]]
        i = i[n[i] >= t * n[i + d] - 1e-6]
        if not len(i):
            return
        j = i + d
        room = np.minimum(n[i] - at[i], n[j] - at[j])
        fits = (root[i] != root[j]) & (key[i] != key[j]) & (room >= _needed(n[i], n[j], t))
        yield i[fits], j[fits]
        d += 1


def _open(t: float):
    """Rows (token, key, n, at, root) sorted by (token, n, key) to those that fit another row of their cell.

    Of a cell of more than ``PIECE`` rows all are kept if there are several components.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, cols in _whole_cells(batches, HELD):
            token, root = cols[0], cols[4]
            keep = np.full(len(token), not whole)
            if whole:
                start = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
                size = np.diff(np.r_[start, len(token)])
                several = np.minimum.reduceat(root, start) != np.maximum.reduceat(root, start)
                keep = np.repeat(several & (size > PIECE), size)
                small = np.flatnonzero(np.repeat(several & (size <= PIECE), size))
                if len(small):
                    for i, j in _fitting([c[small] for c in cols], t):
                        keep[small[i]] = keep[small[j]] = True
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in cols], ["token", "key", "n", "at", "root"])

    return run


def _forest(t: float):
    """Rows (token, key, n, at, root, sketch) sorted by (token, n, key) to pairs ``(a, b)``: a smallest forest of what sketches allow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, cols in _whole_cells(batches, PIECE):
            # a cell that lies inside a batch is cut here
            start = np.flatnonzero(np.r_[True, cols[0][1:] != cols[0][:-1]])
            place = np.arange(len(cols[0])) - np.repeat(start, np.diff(np.r_[start, len(cols[0])]))
            cols[0] = np.cumsum(place % PIECE == 0)
            token, key, n, root = cols[0], cols[1], cols[2], cols[4]
            sketch = np.stack(cols[5:], axis=1).view(np.uint64)
            left, right, far = [], [], []
            for i, j in _fitting(cols, t):
                apart = np.bitwise_count(sketch[i] ^ sketch[j]).sum(axis=1, dtype=np.int64)
                ok = apart <= (1 - t) / (1 + t) * (n[i].astype(np.int64) + n[j]) + 1e-6
                left.append(i[ok])
                right.append(j[ok])
                far.append(apart[ok])
            if not left:
                continue
            i, j, far = (np.concatenate(c) for c in (left, right, far))
            # the closest first; keys settle ties, so that the cells of a group choose the same pairs
            a, b = np.minimum(key[i], key[j]), np.maximum(key[i], key[j])
            order = np.lexsort((b, a, far))
            i, j, a, b = i[order], j[order], a[order], b[order]
            # rows of one cell and component are one from the start
            label = np.unique(np.stack([token, root]), axis=1, return_inverse=True)[1].ravel()
            chosen = []
            while True:
                some = np.flatnonzero(label[i] != label[j])
                if not len(some):
                    break
                best = np.full(len(label), len(i))
                np.minimum.at(best, label[i[some]], some)
                np.minimum.at(best, label[j[some]], some)
                new = np.unique(best[best < len(i)])
                chosen.append(new)
                x, y, to = label[i[new]], label[j[new]], np.arange(len(label))
                while (to[x] != to[y]).any():
                    low = np.minimum(to[x], to[y])
                    np.minimum.at(to, x, low)
                    np.minimum.at(to, y, low)
                label = to[label]
            if chosen:
                k = np.concatenate(chosen)
                yield pa.RecordBatch.from_arrays([pa.array(a[k]), pa.array(b[k])], ["a", "b"])

    return run


def _sketches(texts: DataFrame, size: int) -> DataFrame:
    """``(key, s0, s1, ...)``: the parity sketch of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.zeros((batch.num_rows, 64 * SKETCH), np.uint8)
            for k, text in enumerate(batch.column(1)):
                bits[k] = np.bincount((shingles(text.as_py(), size) % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
            longs = np.packbits(bits, axis=1, bitorder="little").view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(longs[:, i]) for i in range(SKETCH))], ["key", *(f"s{i}" for i in range(SKETCH))])

    return texts.mapInArrow(run, "key long, " + ", ".join(f"s{i} long" for i in range(SKETCH)))


def _allowed(t: float) -> Column:
    """Whether sizes, places and sketches of two texts (the second with names after ``_``) allow the similarity."""
    room = F.least(F.expr("n - at"), F.expr("_n - _at"))
    both = F.col("n") + F.col("_n")
    apart = sum((F.bit_count(F.col(f"s{i}").bitwiseXOR(F.col(f"_s{i}"))) for i in range(SKETCH)), F.lit(0))
    fits = (F.least("n", "_n") >= t * F.greatest("n", "_n") - 1e-6) & (room >= F.ceil(t / (1 + t) * both - 1e-6))
    return fits & (apart <= (1 - t) / (1 + t) * both + 1e-6)


def _verified(texts: DataFrame, pairs: DataFrame, size: int, t: float) -> DataFrame:
    """Those of the stored ``pairs(a, b)`` that are similar enough by their whole sets."""

    @F.pandas_udf("boolean")
    def similar(a: pd.Series, b: pd.Series) -> pd.Series:
        found, was, x = np.zeros(len(a), bool), None, None
        for k, (ta, tb) in enumerate(zip(a, b, strict=True)):
            if k == 0 or ta != was:
                was, x = ta, shingles(ta, size)
            y = shingles(tb, size)
            both = len(np.intersect1d(x, y, assume_unique=True))
            found[k] = both >= t * (len(x) + len(y) - both) - 1e-6
        return pd.Series(found)

    with passing(texts.sparkSession) as store:
        used = store(pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct())
        # copies meet in their tasks before the join
        held = store(texts.filter(may_be_among(used, "key")(F.col("key"))).dropDuplicates(["key"]).join(used, "key", "left_semi"))
        release(texts.sparkSession)
        hot = store(pairs.groupBy("a").count().filter(F.col("count") > HOT).select("a", F.lit(True).alias("_hot")))
        salt = F.when(F.col("_hot"), F.pmod(F.hash("b"), F.lit(SALTS))).otherwise(0)
        one = join_small(pairs, hot, ["a"], max_rows=FEW).select("a", "b", salt.alias("_salt")).join(held.select(F.col("key").alias("b"), F.col("text").alias("_tb")), "b")
        many = join_small(held.select(F.col("key").alias("a"), F.col("text").alias("_ta")), hot, ["a"], max_rows=FEW)
        salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        two = many.select("a", "_ta", F.explode(salts).alias("_salt"))
        return durable(one.join(two, ["a", "_salt"]).filter(similar("_ta", "_tb")).select("a", "b"))


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` with the component of ``key``; a text without links is its own. A text has as many rows as shingles are filed."""
    named = roots.select(F.col("node").alias("key"), F.col("root").alias("_root"))
    return rows.join(named, "key", "left").select("token", "key", "n", "at", F.coalesce("_root", "key").alias("root"))


def similar_links(docs: DataFrame, size: int = 5, min_similarity: float = 0.8, text_col: str = "text", proposed: DataFrame | None = None) -> DataFrame:
    """Links ``(a, b)`` between keys of texts whose components are those of all pairs at ``min_similarity`` or more.

    ``proposed(a, b)``, pairs of keys that may be similar, are checked first; they change the amount of work, never the components.
    """
    t = min_similarity
    spark = docs.sparkSession
    texts = docs.select(key_of(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    with passing(spark) as store:
        filed = _filed(texts, size, t, _common(texts, size))
        cells = store(filed.repartition("token").sortWithinPartitions("token", "n", "key").mapInArrow(_cells(t), CELLS))
        release(spark)
        tried = store(cells.filter("near").groupBy(F.col("lead").alias("a"), F.col("key").alias("b")).agg(F.count("*").alias("shared")))
        release(spark)
        best = tried.groupBy("b").agg(F.max(F.struct("shared", "a")).alias("_best")).select("_best.a", "b")
        done = store((best if proposed is None else best.union(proposed)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        links = _verified(texts, done, size, t)

        def opened(rows):
            """Rows of the cells that may still give a link, with their components by now."""
            told = _rooted(rows.select("token", "key", "n", "at"), store(connected_components(links)))
            kept = told.repartition("token").sortWithinPartitions("token", "n", "key").mapInArrow(_open(t), OPEN)
            return store(kept)

        x = opened(cells)
        release(spark)
        keys = store(x.select("key").distinct())
        # some texts without an open row get a sketch, too, which no join takes
        sketches = store(_sketches(texts.filter(may_be_among(keys, "key")(F.col("key"))), size).dropDuplicates(["key"]))
        own = ["key", "n", "at", "root", *(f"s{i}" for i in range(SKETCH))]
        sketched = x.join(sketches, "key").select("token", *own)
        near = sketched.repartition("token").sortWithinPartitions("token", "n", "key").mapInArrow(_forest(t), "a long, b long")
        near = store(near.distinct().join(done, ["a", "b"], "left_anti"))
        release(spark)
        links = links.union(_verified(texts, near, size, t))
        x = opened(x)
        sketched = x.join(sketches, "key").select("token", *own)
        other = sketched.select("token", *[F.col(c).alias(f"_{c}") for c in own])
        pair = [F.least("key", "_key").alias("a"), F.greatest("key", "_key").alias("b")]
        left = sketched.join(other, "token").filter(F.expr("key < _key and root != _root") & _allowed(t)).select(*pair).distinct()
        left = store(left.join(done.union(near), ["a", "b"], "left_anti"))
        release(spark)
        return links.union(_verified(texts, left, size, t))
