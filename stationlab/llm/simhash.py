"""SimHash near-duplicates by pivot distance tables.

A text's fingerprint takes the majority of every bit over the XXH64 of its word shingles. Fingerprints that differ in at
most two bits are linked; groups are the connected components. Work is done on distinct fingerprints, so copies cost nothing.

Two fingerprints within two bits agree in at least two of four 16-bit bands, so each is filed under its six pairs of bands.
Inside a cell the Hamming distances to ``PIVOTS`` reference fingerprints are tabled first; a pair is discarded when any
coordinate differs by more than two (triangle inequality) and the survivors are verified bit by bit. A cell of more than
``CELL`` fingerprints is not paired: its members are filed under every value within one bit. Two of them share such a
value exactly if they are within two bits, and no value has more than 65 of them, so this is exact and linear too.

Null, empty and blank texts have fingerprint zero and are linked like any other; null ids come after all others; repeated
rows are rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scale import durable
from .common import may_be_among, release, row_key
from .components import connected_components
from .shingle_join import key_of, similar_links

PIVOTS = 32
CELL = 128
RADIUS = 2


def fingerprint(text, size: int = 3) -> int:
    """The fingerprint of a text over shingles of ``size`` words; A-Z are lowered, white space is ASCII's."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []
    if not words:
        return 0
    if len(words) <= size:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    n = len(words) - size + 1
    h64 = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 16384):
        part = words[k : min(n, k + 16384) + size - 1]
        h = np.fromiter((h64(s, 42) for s in map(b" ".join, zip(*(part[i:] for i in range(size)), strict=False))), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprint_of(text: Column, size: int = 3) -> Column:
    """Fingerprint of a text as a long."""

    @F.pandas_udf("long")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, size) for t in s], np.uint64).view(np.int64))

    return run(text)


def _pair_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (pair of bands, cell, fingerprint) to links ``(a, b)``; members of large cells come out with ``b`` null."""
    pivots = np.random.default_rng(64).integers(0, 2**64, PIVOTS, np.uint64)
    none = np.zeros(0, np.int64)
    held = (none, none, none)  # the cell that is not complete yet, CELL rows at most
    large = None  # a large cell whose rows may go on

    def out(a, b=None):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()) if b is not None else pa.nulls(len(a), pa.int64())], ["a", "b"])

    def links(cell, fp):
        """Spanning links of what pairs up inside the cells; labels run to the smallest row that is reached."""
        u = fp.view(np.uint64)
        table = np.bitwise_count(u[:, None] ^ pivots[None, :]).astype(np.int8)
        left, right, d = [], [], 1
        while True:
            i = np.flatnonzero(cell[d:] == cell[:-d])
            if not len(i):
                break
            near = i[np.abs(table[i] - table[i + d]).max(axis=1) <= RADIUS]
            near = near[np.bitwise_count(u[near] ^ u[near + d]) <= RADIUS]
            left.append(near)
            right.append(near + d)
            d += 1
        if not left:
            return none, none
        i, j = np.concatenate(left), np.concatenate(right)
        label = np.arange(len(fp))
        while len(i):
            old = label.copy()
            low = np.minimum(label[i], label[j])
            np.minimum.at(label, i, low)
            np.minimum.at(label, j, low)
            if (label == old).all():
                break
        k = np.flatnonzero(label != np.arange(len(fp)))
        return fp[k], fp[label[k]]

    def work(combo, cell, fp):
        """Complete cells: large ones handed on, the others paired."""
        new = np.flatnonzero(np.r_[True, (combo[1:] != combo[:-1]) | (cell[1:] != cell[:-1])])
        size = np.diff(np.r_[new, len(fp)])
        of = np.repeat(np.arange(len(new)), size)
        big = size[of] > CELL
        if big.any():
            yield out(fp[big])
        some = (size[of] > 1) & ~big
        if some.any():
            a, b = links(of[some], fp[some])
            if len(a):
                yield out(a, b)

    for batch in batches:
        combo, cell, fp = (np.concatenate([h, batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64)]) for k, h in enumerate(held))
        if large is not None:
            more = (combo == large[0]) & (cell == large[1])
            if more.any():
                yield out(fp[more])
                combo, cell, fp = combo[~more], cell[~more], fp[~more]
        if not len(fp):
            held = (none, none, none)
            continue
        last = (combo == combo[-1]) & (cell == cell[-1])
        large = None
        if last.sum() > CELL:
            large = (combo[-1], cell[-1])
            yield out(fp[last])
            held = (none, none, none)
        else:
            held = (combo[last], cell[last], fp[last])
        if not last.all():
            yield from work(combo[~last], cell[~last], fp[~last])
    if len(held[2]):
        yield from work(*held)


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all pairs of distinct ``fps(fp)`` within two bits."""
    bands = [(0xFFFF << (16 * k)) for k in range(4)]
    masks = [bands[i] | bands[j] for i, j in combinations(range(4), 2)]
    signed = [m - 2**64 if m >= 2**63 else m for m in masks]
    filed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("combo", "cell"))
    # the pair of bands, the cell value and the fingerprint order the rows; no cell is gathered
    dealt = filed.select(F.col("combo").cast("long").alias("combo"), "cell", "fp").repartition("combo", "cell").sortWithinPartitions("combo", "cell", "fp")
    found = durable(dealt.mapInArrow(_pair_cells, "a long, b long"))
    crowded = found.filter("b is null").select(F.col("a").alias("fp")).distinct()
    around = F.concat(F.array("fp"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))
    shared = crowded.select("fp", F.explode(around).alias("at")).groupBy("at").agg(F.collect_set("fp").alias("s")).filter(F.size("s") > 1)
    stars = shared.select(F.array_min("s").alias("b"), F.explode("s").alias("a")).filter("a != b").select("a", "b").distinct()
    return found.filter("b is not null").union(stars)


def proposed_pairs(docs: DataFrame, size: int, text_col: str = "text") -> DataFrame:
    """Pairs ``(a, b)`` of text keys whose fingerprints are equal or linked; the smallest key stands for a fingerprint."""
    text = F.col(text_col)
    fps = durable(docs.select(key_of(text).alias("key"), fingerprint_of(text, size).alias("fp")).distinct())
    first = durable(fps.groupBy("fp").agg(F.min("key").alias("first")))
    release(docs.sparkSession)
    same = fps.join(first, "fp").filter("key != first").select(F.col("first").alias("a"), F.col("key").alias("b"))
    links = durable(fingerprint_links(first.select("fp")))
    for c in ("a", "b"):
        links = links.join(first.select(F.col("fp").alias(c), F.col("first").alias(f"_{c}")), c).drop(c).withColumnRenamed(f"_{c}", c)
    return same.union(links.select("a", "b"))


def near_duplicates(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text", min_similarity: float | None = None) -> DataFrame:
    """``(id, row_key, fp, root, component_id)`` per document; ``row_key`` stands for id and text together, ``root`` for the
    group (ids may be repeated, so they do not tell groups apart).

    With ``min_similarity`` the Jaccard similarity of the whole shingle sets decides: links of fingerprints within two bits
    are checked by it, texts beyond two bits that are similar enough are found by their shingles, and ``fp`` is a key of the
    text.
    """
    text = F.col(text_col)
    fp = fingerprint_of(text, size) if min_similarity is None else key_of(text)
    fps = durable(docs.select(F.col(id_col), row_key(F.col(id_col), text).alias("row_key"), fp.alias("fp")))
    own = durable(fps.groupBy("fp").agg(F.min(id_col).alias("_own")))
    if min_similarity is None:
        links = fingerprint_links(own.select("fp"))
    else:
        links = similar_links(docs, size, min_similarity, text_col, proposed_pairs(docs, size, text_col))
    roots = durable(connected_components(links))
    release(docs.sparkSession)
    low = roots.join(own, roots["node"] == own["fp"]).groupBy("root").agg(F.min("_own").alias("_low"))
    linked = durable(roots.join(low, "root").select(F.col("node").alias("fp"), "root", "_low"))
    ids = own.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("_low", "_own").alias("component_id"))
    # rows of a hot fingerprint are narrow here, and the join splits them
    return fps.join(durable(ids), "fp").select(id_col, "row_key", "fp", "root", "component_id")


def simhash_report(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: fingerprint in hexadecimal and the smallest id of its group."""
    return near_duplicates(docs, size, id_col, text_col).select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text", min_similarity: float | None = None) -> DataFrame:
    """One document of each group, the one with the smallest id; of rows equal in id and text one stays."""
    found = durable(near_duplicates(docs, size, id_col, text_col, min_similarity))
    release(docs.sparkSession)
    # groups of one row are left alone; null ids come last, ties go by the row key
    shared = durable(found.groupBy("root").agg(F.count("*").alias("_n"), F.min(F.struct(F.col(id_col).isNull(), id_col, "row_key")).alias("_first")).filter("_n > 1").select("root", F.col("_first.row_key").alias("_kept")))
    inside = found.join(shared, "root")
    gone = inside.filter("row_key != _kept").select("row_key").distinct()
    twice = durable(inside.filter("row_key = _kept").groupBy("row_key").count().filter("count > 1").select("row_key"))
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), row_key(F.col(id_col), F.col(text_col)).alias("row_key"))
    left_out = durable(gone.union(twice).distinct())
    release(docs.sparkSession)
    # most rows are told by a filter of the keys and never shuffled
    doubt = may_be_among(left_out, "row_key")(F.col("row_key"))
    settled = keyed.filter(doubt).join(left_out, "row_key", "left_anti")
    once = keyed.filter(~doubt).select("_row.*").union(settled.select("_row.*"))
    if twice.isEmpty():
        return once
    # equal rows meet in their tasks before the join
    some = keyed.filter(may_be_among(twice, "row_key")(F.col("row_key"))).dropDuplicates(["row_key"])
    return once.unionByName(some.join(twice, "row_key", "left_semi").select("_row.*"))
