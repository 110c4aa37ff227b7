"""Substring dedup by recompression.

Words become 64-bit names. In rounds, runs of one name and pairs of names (left and right ones, told by a bit of the name)
get names of their own. A name is a hash of what it stands for, so all tasks agree on it without asking: equal stretches of
text get the same symbols everywhere, but for a few at either end. With spans of at most 2 and 4 words in the two rounds,
at most ``BORDER`` words at either end of a window can be parsed differently in another place.

Each window takes the symbol with the smallest scrambled name inside that border as its anchor, so equal windows share it at
the same place. Neighbouring windows with one anchor form a row: (name of the words around the anchor, name of the whole
stretch, document, place). One shuffle brings rows of one anchor together, sorted: a stretch whose name was seen in a smaller
document is settled at once; stretches that share an anchor but differ somewhere are looked up again and compared window by
window.

Null texts have no words. Copies of a text are told by its key and lose everything but what is in their smallest document;
documents of equal id do not count as smaller than each other, null ids count as largest; very long texts are worked on in
overlapping slices; repeated rows, empty tables and further columns have no special meaning.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scale import durable
from .common import join_small, mixed, text_key

SPANS = (2, 4)  # words that a symbol of each round may cover
BORDER = 12
#: Words that are worked on at once.
SLICE = 100_000
LAST = 2**63 - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE + 1000)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def prefix_sums(h: np.ndarray) -> np.ndarray:
    """Sums from which :func:`stretch_names` names any stretch."""
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * powers(len(h))[0][: len(h)], dtype=np.uint64)])


def stretch_names(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit names of stretches: equal for equal contents, wherever they stand."""
    return mixed((sums[end] - sums[begin]) * powers(len(sums))[1][begin] + (end - begin).astype(np.uint64))


def words_of(text) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if isinstance(text, str) else []


def word_names(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def recompress(names: np.ndarray, doc: np.ndarray, spans: tuple[int, ...] = SPANS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols ``(begin, end, name)`` after one round of runs and pairs for each entry of ``spans``; none crosses documents."""
    begin = np.arange(len(names))
    end = begin + 1
    for k, span in enumerate(spans):
        if not len(names):
            break
        head = np.flatnonzero(np.r_[True, (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])])
        tail = np.r_[head[1:], len(names)] - 1
        count = tail - head + 1
        one = (count > 1) & (end[tail] - begin[head] <= span)
        keep = np.ones(len(names), bool)
        if one.any():
            of = np.repeat(one, count)
            keep = ~of
            keep[head[one]] = True
            end = end.copy()
            end[head[one]] = end[tail[one]]
            names = names.copy()
            names[head[one]] = mixed(names[head[one]] * np.uint64(0x2545F4914F6CDD1D) + count[one].astype(np.uint64))
            names, begin, end, doc = names[keep], begin[keep], end[keep], doc[keep]
        right = (mixed(names + np.uint64(k + 1)) >> np.uint64(63)).astype(bool)
        at = np.flatnonzero(~right[:-1] & right[1:] & (doc[1:] == doc[:-1]) & (end[1:] - begin[:-1] <= span))
        names, end = names.copy(), end.copy()
        names[at] = mixed(names[at] * np.uint64(0x9FB21C651E98DF25) + mixed(names[at + 1]))
        end[at] = end[at + 1]
        keep = np.ones(len(names), bool)
        keep[at + 1] = False
        names, begin, end, doc = names[keep], begin[keep], end[keep], doc[keep]
    return begin, end, names


def anchor_rows(h: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Anchors of word names ``h`` of texts that begin at ``offsets`` (the end last): anchor name, stretch name, text number,
    first window and number of windows."""
    sizes = np.diff(offsets)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    begin, end, names = recompress(h, doc)
    n_win = np.maximum(0, sizes - window + 1)
    if not n_win.sum():
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z.astype(np.uint64), z, z, z
    g_doc = np.repeat(np.arange(len(sizes)), n_win)
    g = np.arange(n_win.sum()) - np.repeat(np.cumsum(n_win) - n_win, n_win) + offsets[g_doc]
    n = len(h)
    starts_before = np.concatenate([[0], np.cumsum(np.bincount(begin, minlength=n + 1))])  # symbols that begin before x
    ends_until = np.cumsum(np.bincount(end, minlength=n + 1))  # symbols that end at x at the latest
    lo, hi = starts_before[g + BORDER], ends_until[g + window - BORDER]
    value = mixed(names + np.uint64(77))
    levels = [np.arange(len(names))]
    while (1 << len(levels)) <= window:
        low, d = levels[-1], 1 << (len(levels) - 1)
        nxt = low.copy()
        if d < len(low):
            nxt[:-d] = np.where(value[low[:-d]] <= value[low[d:]], low[:-d], low[d:])
        levels.append(nxt)
    k = np.floor(np.log2(hi - lo)).astype(np.int64)
    table = np.stack(levels)
    a, b = table[k, lo], table[k, hi - (1 << k)]
    pick = begin[np.where(value[a] <= value[b], a, b)]
    new = np.flatnonzero(np.r_[True, (pick[1:] != pick[:-1]) | (g_doc[1:] != g_doc[:-1])])
    count = np.diff(np.r_[new, len(g)])
    first, pick = g[new], pick[new]
    sums = prefix_sums(h)
    around = stretch_names(sums, pick - BORDER, pick + BORDER)
    whole = mixed(stretch_names(sums, first, first + count + window - 1) + (pick - first).astype(np.uint64))
    return around, whole, g_doc[new], first - offsets[g_doc[new]], count


_ROW = "a long, c long, doc long, key binary, pos int, n int, settled boolean"


def _rows(a, c, doc, keys, pos, n) -> Iterator[pa.RecordBatch]:
    """Rows for the shuffle; those whose stretch stands in a smaller document of the same slice are settled here."""
    order = np.lexsort((doc, c, a))
    a, c, doc, keys, pos, n = a[order], c[order], doc[order], keys[order], pos[order], n[order]
    head = np.r_[True, (a[1:] != a[:-1]) | (c[1:] != c[:-1])] if len(a) else np.zeros(0, bool)
    least = doc[np.flatnonzero(head)][np.cumsum(head) - 1] if len(a) else doc
    for k in range(0, len(a), 20_000):
        s = slice(k, k + 20_000)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a[s].view(np.int64)), pa.array(c[s].view(np.int64)), pa.array(doc[s], pa.int64()), pa.array(keys[s].tolist(), pa.binary()), pa.array(pos[s].astype(np.int32)), pa.array(n[s].astype(np.int32)), pa.array(doc[s] > least[s])],
            ["a", "c", "doc", "key", "pos", "n", "settled"],
        )


def in_slices(items: Iterator[tuple], length, overlap: int, most: int | None = None) -> Iterator[list[tuple]]:
    """Groups of ``(begin, end, item)`` of about ``most`` units (``SLICE``); an item longer than that comes in overlapping parts."""
    most = most or SLICE
    wait, total = [], 0
    for item in items:
        n = length(item)
        for b in range(0, max(1, n - overlap), most - overlap):
            e = min(n, b + most)
            wait.append((b, e, item))
            total += e - b
            if total >= most:
                yield wait
                wait, total = [], 0
    if wait:
        yield wait


def _scan(window: int):
    def run(batches):
        seen: dict = {}

        def texts():
            for b in batches:
                for key, doc, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                    if seen.get(key, LAST + 1) <= doc:  # a copy of a text of a smaller document
                        continue
                    if len(seen) > 100_000:
                        seen.clear()
                    seen[key] = doc
                    words = words_of(t.as_py())
                    if len(words) >= window:
                        yield key, doc, word_names(words)

        for group in in_slices(texts(), lambda x: len(x[2]), window - 1):
            h = np.concatenate([x[2][b:e] for b, e, x in group])
            a, c, of, pos, n = anchor_rows(h, np.cumsum([0, *(e - b for b, e, _ in group)]), window)
            keys = np.array([x[0] for _, _, x in group], object)[of]
            doc, at = np.array([x[1] for _, _, x in group], np.int64)[of], np.array([b for b, _, _ in group], np.int64)[of]
            yield from _rows(a, c, doc, keys, pos + at, n)

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (a, c, doc) to ``(key, doc, pos, n, check)``: stretches that a smaller document has, and with ``check``
    the first of each stretch whose anchor has other stretches too. Holds back rows of one stretch of one document at most."""
    prev_a = prev_c = least = None
    many, held = False, []

    def out(b, mask, check):
        t = b.select(["key", "doc", "pos", "n"]).filter(pa.array(mask))
        return pa.RecordBatch.from_arrays([*t.columns, pa.array(np.full(t.num_rows, check))], ["key", "doc", "pos", "n", "check"])

    for b in batches:
        done = b.column("settled").to_numpy(zero_copy_only=False).astype(bool)
        if done.any():
            yield out(b, done, False)
            b = b.filter(pa.array(~done))
        if not b.num_rows:
            continue
        a, c, doc = (b.column(x).to_numpy(zero_copy_only=False) for x in ("a", "c", "doc"))
        goes_on = prev_a is not None and a[0] == prev_a
        new_a = np.r_[not goes_on, a[1:] != a[:-1]]
        new_c = new_a | np.r_[not goes_on or c[0] != prev_c, c[1:] != c[:-1]]
        heads = np.r_[least if least is not None else 0, doc[np.flatnonzero(new_c)]]
        low = heads[np.cumsum(new_c)]
        group = np.cumsum(new_a)  # 0 is the group that goes on
        stretches = np.bincount(group[new_c], minlength=group[-1] + 1)
        if goes_on:
            stretches[0] += 2 if many else 1
        if not goes_on or stretches[0] > 1:
            yield from held if goes_on else ()
            held = []
        later = doc > low
        if later.any():
            yield out(b, later, False)
        check = ~later & (stretches[group] > 1)
        if check.any():
            yield out(b, check, True)
        many = bool(stretches[group[-1]] > 1)
        if not many:
            wait = ~later & (group == group[-1])
            if wait.any():
                held.append(out(b, wait, True))
        prev_a, prev_c, least = a[-1], c[-1], low[-1]


def _windows(window: int):
    """Texts with the stretches to check, as ``key, doc, text, [pos, n, pos, n, ...]``, to one row per window."""

    def run(batches):
        for b in batches:
            wait, total = [], 0
            for key, doc, t, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3).to_pylist(), strict=True):
                h = word_names(words_of(t.as_py()))
                sums = prefix_sums(h)
                at = np.array(at, np.int64).reshape(-1, 2)
                first = np.unique(np.concatenate([np.arange(p, p + n) for p, n in at]))
                wait.append((stretch_names(sums, first, first + window), np.full(len(first), doc), np.array([key] * len(first), object), first))
                total += len(first)
                if total > SLICE:
                    yield from flush(wait)
                    wait, total = [], 0
            if wait:
                yield from flush(wait)

    def flush(wait):
        name, doc, keys, first = (np.concatenate(x) for x in zip(*wait, strict=True))
        yield from _rows(name, name, doc, keys, first, np.ones(len(first), np.int64))

    return run


def _sorted(rows: DataFrame) -> DataFrame:
    spread = F.when(F.col("settled"), F.xxhash64("key", "pos")).otherwise(F.col("a"))
    return rows.repartition(spread).sortWithinPartitions("a", "c", "doc")


def repeated_stretches(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents as ``(key, doc)`` with what they lose: ``spans array<int>`` of (begin, end) words, or ``whole``."""
    rows = docs.select(text_key(F.col(text_col)).alias("key"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), F.col(text_col).alias("text"))
    settled = "key binary, doc long, pos int, n int, check boolean"
    found = durable(_sorted(rows.mapInArrow(_scan(window), _ROW)).mapInArrow(_settle, settled))
    checks = durable(found.filter("check").groupBy("key", "doc").agg(F.flatten(F.collect_set(F.array("pos", "n"))).alias("at")))
    looked = join_small(rows, checks, ["key", "doc"], "inner", salts=1).select("key", "doc", "text", "at").mapInArrow(_windows(window), _ROW)
    again = _sorted(looked).mapInArrow(_settle, settled).filter("not check")
    span = F.array(F.col("pos"), F.col("pos") + F.col("n") + (window - 1))
    spans = found.filter("not check").union(again).groupBy("key", "doc").agg(F.sort_array(F.collect_set(span)).alias("s"))
    ids = rows.select("key", "doc")
    shared = durable(ids.groupBy("key").agg(F.min("doc").alias("own"), F.max("doc").alias("last")).filter("own < last").select("key", "own"))
    copies = join_small(ids, shared, ["key"], "inner").filter("doc > own").select("key", "doc").distinct().withColumn("whole", F.lit(True))
    lost = spans.join(copies, ["key", "doc"], "full").select("key", "doc", F.flatten("s").alias("spans"), F.coalesce("whole", F.lit(False)).alias("whole"))
    return rows, durable(lost)


def kept_words(text, spans, whole: bool, window: int) -> tuple[int, list[bytes]]:
    """Number of words of a text and those that stay."""
    words = words_of(text)
    if whole and len(words) >= window:
        return len(words), []
    if spans is None or not len(spans):
        return len(words), words
    out, at = [], 0
    for b, e in np.asarray(spans, np.int64).reshape(-1, 2):
        if b > at:
            out += words[at:b]
        at = max(at, e)
    return len(words), out + words[at:]


def _marked(docs: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    _, lost = repeated_stretches(docs, window, id_col, text_col)
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), text_key(F.col(text_col)).alias("key"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"))
    return join_small(keyed, lost, ["key", "doc"], "left", salts=1)


def dedup_report(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: words, removed words, digest of what stays."""

    @F.pandas_udf("n_words long, n_removed long, kept_sha256 string")
    def digest(texts: pd.Series, spans: pd.Series, whole: pd.Series) -> pd.DataFrame:
        rows = []
        for t, s, w in zip(texts, spans, whole, strict=True):
            n, kept = kept_words(t, s, w is True, window)
            rows.append((n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256"])

    m = _marked(docs, window, id_col, text_col)
    return m.select(F.col(f"_row.{id_col}"), digest(F.col(f"_row.{text_col}"), "spans", "whole").alias("d")).select(id_col, "d.*")


def kept_text(text: Column, spans: Column, whole: Column, window: int) -> Column:
    """What stays of a text that loses words: the kept words, one space apart; null if nothing does."""

    @F.pandas_udf("string")
    def run(texts: pd.Series, s: pd.Series, w: pd.Series) -> pd.Series:
        kept = [kept_words(t, x, y is True, window)[1] for t, x, y in zip(texts, s, w, strict=True)]
        return pd.Series([b" ".join(k).decode("utf-8", "surrogatepass") if k else None for k in kept], dtype=object)

    return run(text, spans, whole)


def drop_repeats(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """Documents without the repeated stretches. Untouched texts stay as they are, letter for letter; documents that lose
    every word go; ``size_col``, where there is one, follows the text."""
    m = _marked(docs, window, id_col, text_col)
    text = F.col(f"_row.{text_col}")
    touched = F.col("spans").isNotNull() | (F.col("whole") & (F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)) >= window))
    m = m.withColumn("_hit", F.coalesce(touched, F.lit(False)))
    m = m.withColumn("_new", kept_text(F.when(F.col("_hit"), text), F.col("spans"), F.col("whole"), window)).filter("not _hit or _new is not null")
    new = {text_col: F.when(F.col("_hit"), F.col("_new")).otherwise(text)}
    if size_col in docs.columns:
        new[size_col] = F.when(F.col("_hit"), F.length("_new").cast(docs.schema[size_col].dataType)).otherwise(F.col(f"_row.{size_col}"))
    return m.select(*[new.get(c, F.col(f"_row.{c}")).alias(c) for c in docs.columns])
