"""Suffix-array dedup with a run-length index: every byte that a string of ``window`` bytes covers that also starts elsewhere.

1. Places that can matter: each window takes its smallest 64-byte gram as anchor. Neighbouring windows of one anchor form
   a row (name of the gram, name of the whole stretch, text, place); one shuffle brings the rows of an anchor together.
   A stretch found at two places is repeated as a whole. Anchors with several different stretches are looked at closely.
2. Those stretches, one place for each, are dealt out by anchor. A task turns some hundred kilobytes of them into a Burrows-Wheeler
   transform kept by runs, with the suffix positions sampled at both ends of every run and the match length measured
   there. Between samples the match length falls by one from each text position to the next, so the matching statistics
   of the whole piece stream out of the samples; where they reach ``window`` the bytes are marked.
3. An anchor with more than ``LARGE`` bytes of stretches is not indexed by one task: its windows are named and shuffled.

Copies of a text collapse by its key and are removed whole. Null texts are empty; ids play no part; very long texts are
worked on in overlapping slices; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.scale import durable
from .common import join_small, mixed, text_key
from .recompression import in_slices, prefix_sums, stretch_names

GRAM_STEPS = 6  # doublings: grams of 64 bytes
GRAM = 1 << GRAM_STEPS
BATCH, LARGE = 300_000, 4_000_000
SLICE = 400_000  # bytes that are worked on at once
_PLACE = np.uint64((1 << 20) - 1)
_BYTE = np.random.default_rng(256).integers(0, 2**64, 256, np.uint64)
_BASE = 0xD6E8FEB86659FD93


def gram_names(x: np.ndarray) -> np.ndarray:
    """Name of the 64-byte gram at every place; the last 63 are not meant to be used."""
    h, base = _BYTE[x], _BASE
    for k in range(GRAM_STEPS):
        d = 1 << k
        h[:-d] = h[:-d] * np.uint64(base) + h[d:] if d < len(h) else h[:-d]
        base = base * base % 2**64
    return mixed(h)


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` neighbours, from each place on."""
    done = 1
    while done * 2 <= width:
        v = np.minimum(v[: len(v) - done], v[done:])
        done *= 2
    rest = width - done
    return np.minimum(v[: len(v) - rest], v[rest:]) if rest else v


def anchor_rows(x: np.ndarray, offsets: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Anchor name, stretch name, text number, first window and number of windows; ``offsets`` as in the word version."""
    n_win = np.maximum(0, np.diff(offsets) - window + 1)
    of = np.repeat(np.arange(len(n_win)), n_win)
    g = np.arange(n_win.sum()) - np.repeat(np.cumsum(n_win) - n_win, n_win) + offsets[of]
    if not len(g):
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z.astype(np.uint64), z, z, z
    names = gram_names(x)
    least = sliding_min((names & ~_PLACE) | np.arange(len(x)).astype(np.uint64), window - GRAM + 1)
    pick = (least[g] & _PLACE).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (pick[1:] != pick[:-1]) | (of[1:] != of[:-1])])
    count = np.diff(np.r_[new, len(g)])
    first, pick, of = g[new], pick[new], of[new]
    whole = mixed(stretch_names(prefix_sums(_BYTE[x]), first, first + count + window - 1) + (pick - first).astype(np.uint64))
    return names[pick], whole, of, first - offsets[of], count


_ROW = "a long, c long, key binary, pos int, n int, settled boolean"
_OUT = "a long, key binary, pos int, n int, check boolean"


def raw_of(text) -> bytes:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def _scan(window: int):
    def rows(a, c, key, pos, n, settled):
        for k in range(0, len(a), 20_000):
            s = slice(k, k + 20_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[s].view(np.int64)), pa.array(c[s].view(np.int64)), pa.array(key[s].tolist(), pa.binary()), pa.array(pos[s].astype(np.int32)), pa.array(n[s].astype(np.int32)), pa.array(settled[s])],
                ["a", "c", "key", "pos", "n", "settled"],
            )

    def run(batches):
        seen: set = set()

        def texts():
            for b in batches:
                for key, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    if key not in seen:
                        if len(seen) > 100_000:
                            seen.clear()
                        seen.add(key)
                        raw = raw_of(t.as_py())
                        if len(raw) >= window:
                            yield key, np.frombuffer(raw, np.uint8)

        for group in in_slices(texts(), lambda x: len(x[1]), window - 1, SLICE):
            x = np.concatenate([t[b:e] for b, e, (_, t) in group])
            a, c, of, pos, n = anchor_rows(x, np.cumsum([0, *(e - b for b, e, _ in group)]), window)
            ids: dict = {}
            number = np.array([ids.setdefault(k, len(ids)) for _, _, (k, _) in group])[of]
            pos = pos + np.array([b for b, _, _ in group], np.int64)[of]
            key = np.array([k for _, _, (k, _) in group], object)[of]
            o = np.lexsort((pos, number, c, a))
            a, c, key, number, pos, n = a[o], c[o], key[o], number[o], pos[o], n[o]
            if not len(a):
                continue
            same = np.r_[False, (a[1:] == a[:-1]) & (c[1:] == c[:-1])]
            again = same & np.r_[False, (number[1:] == number[:-1]) & (pos[1:] == pos[:-1])]
            a, c, key, pos, n, same = (y[~again] for y in (a, c, key, pos, n, same))
            # a stretch that stands twice in this slice is settled; one place of it goes on
            both = same | np.r_[same[1:], False]
            yield from rows(a[both], c[both], key[both], pos[both], n[both], np.ones(both.sum(), bool))
            yield from rows(a[~same], c[~same], key[~same], pos[~same], n[~same], np.zeros((~same).sum(), bool))

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (a, c, key, pos): stretches found at two places, and with ``check`` one place of every stretch whose
    anchor has other stretches too. One row is held back for each purpose."""
    prev = None  # the last row
    first = None  # first place of the current stretch, as long as it is the only one
    many, held = False, []

    def out(b, mask, check):
        t = b.select(["a", "key", "pos", "n"]).filter(pa.array(mask))
        return pa.RecordBatch.from_arrays([*t.columns, pa.array(np.full(t.num_rows, check))], ["a", "key", "pos", "n", "check"])

    for b in batches:
        done = b.column("settled").to_numpy(zero_copy_only=False).astype(bool)
        if done.any():
            yield out(b, done, False)
            b = b.filter(pa.array(~done))
        if not b.num_rows:
            continue
        a, c, pos = (b.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("a", "c", "pos"))
        key = np.array(b.column("key").to_pylist(), object)
        if prev is not None:
            a, c, pos, key = np.r_[prev[0], a], np.r_[prev[1], c], np.r_[prev[2], pos], np.r_[np.array([prev[3]], object), key]
        eq_a = a[1:] == a[:-1]
        eq_c = eq_a & (c[1:] == c[:-1])
        copy = eq_c & (pos[1:] == pos[:-1]) & (key[1:] == key[:-1])
        if prev is None:
            eq_a, eq_c, copy = np.r_[False, eq_a], np.r_[False, eq_c], np.r_[False, copy]
        prev = (a[-1], c[-1], pos[-1], key[-1])
        if copy.any():
            b = b.filter(pa.array(~copy))
            # the row after a copy compares with the row the copy equals, so its flags hold
            eq_a, eq_c = eq_a[~copy], eq_c[~copy]
        if not b.num_rows:
            continue
        more = np.r_[eq_c[1:], False]
        repeated = eq_c | more
        if eq_c[0] and first is not None:
            yield first
        if repeated.any():
            yield out(b, repeated, False)
        head = ~eq_c
        at = np.flatnonzero(head)
        if len(at):
            one = np.zeros(len(head), bool)
            one[at[-1]] = True
            first = out(b, one, False) if at[-1] == len(head) - 1 else None
        else:
            first = None
        group = np.cumsum(~eq_a)
        stretches = np.bincount(group[head], minlength=group[-1] + 1)
        if eq_a[0]:
            stretches[0] += 2 if many else 1
            if stretches[0] > 1:
                yield from held
                held = []
        else:
            held = []
        check = head & (stretches[group] > 1)
        if check.any():
            yield out(b, check, True)
        if group[-1] > 0 or not eq_a[0]:
            held = []
        many = bool(stretches[group[-1]] > 1)
        wait = head & (group == group[-1]) & (not many)
        if wait.any():
            held.append(out(b, wait, True))


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix order of small integers below 512, by doubling: seven symbols at first, ties only from then on."""
    n = len(s)
    key = np.zeros(n, np.uint64)
    padded = np.concatenate([s.astype(np.uint64) + np.uint64(1), np.zeros(7, np.uint64)])
    for t in range(7):
        key = (key << np.uint64(9)) | padded[t : t + n]
    sa = np.argsort(key)
    ordered = key[sa]
    head = np.r_[True, ordered[1:] != ordered[:-1]]
    slot = np.arange(n)
    group = np.maximum.accumulate(np.where(head, slot, 0))
    rank = np.empty(n, np.int64)
    rank[sa] = group
    h = 7
    while True:
        size = np.diff(np.r_[np.flatnonzero(head), n])
        tied = np.flatnonzero(np.repeat(size > 1, size))
        if not len(tied):
            return sa
        at = sa[tied]
        pair = rank[at] * (n + 1) + np.where(at + h < n, rank[np.minimum(at + h, n - 1)] + 1, 0)
        o = np.argsort(pair)
        at, pair = at[o], pair[o]
        sa[tied] = at
        new = np.r_[True, pair[1:] != pair[:-1]]
        head[tied] = new
        rank[at] = np.maximum.accumulate(np.where(new, tied, 0))
        h *= 2


def common_lengths(s: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Lengths of the common beginnings of suffixes; eight symbols at a time."""
    n = len(s)
    padded = np.concatenate([s.astype(np.uint64), np.full(16, 511, np.uint64)])
    wide = np.zeros(n + 8, np.uint64)
    for t in range(7):
        wide = (wide << np.uint64(9)) | padded[t : t + n + 8]
    out = np.zeros(len(x), np.int64)
    live = np.arange(len(x))
    x, y = x.copy(), y.copy()
    while len(live):
        d = wide[np.minimum(x, n)] ^ wide[np.minimum(y, n)]
        same = (d == 0) & (np.maximum(x, y) < n)
        diff = ~same
        lead = np.frexp(d[diff].astype(np.float64))[1]  # highest differing bit; symbols are below 512, nine bits each
        exact = np.maximum(0, (63 - lead) // 9)
        out[live[diff]] += np.minimum(exact, n - np.maximum(x[diff], y[diff])).clip(0)
        out[live[same]] += 7
        live, x, y = live[same], x[same] + 7, y[same] + 7
    return out


class RunIndex:
    """Burrows-Wheeler transform of a text by runs, with suffix positions and match lengths sampled at the run ends."""

    def __init__(self, s: np.ndarray):
        n = self.n = len(s)
        sa = suffix_array(s)
        bwt = np.where(sa > 0, s[sa - 1], 511)
        start = np.flatnonzero(np.r_[True, bwt[1:] != bwt[:-1]])
        end = np.r_[start[1:], n] - 1
        self.symbols, self.lengths = bwt[start], end - start + 1
        self.first, self.last = sa[start], sa[end]
        # match with the suffix before the run's first and behind its last; the very first and last have none
        self.first_match, self.last_match = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        self.first_match[1:] = common_lengths(s, self.first[1:], sa[start[1:] - 1])
        self.last_match[:-1] = common_lengths(s, self.last[:-1], sa[end[:-1] + 1])

    def matching_statistics(self) -> np.ndarray:
        """For each text position the longest match that also starts elsewhere."""
        out = np.zeros(self.n, np.int64)
        place = np.arange(self.n)
        for at, length in ((self.first, self.first_match), (self.last, self.last_match)):
            sample = np.full(self.n, -1, np.int64)
            sample[at] = length
            where = np.maximum.accumulate(np.where(sample >= 0, place, 0))
            out = np.maximum(out, np.maximum(sample[where], 0) - (place - where))
        return out


def repeated_in(regions: list[tuple[bytes, int, np.ndarray]], window: int) -> list[tuple[bytes, int, int]]:
    """Spans ``(key, begin, end)`` of the regions ``(key, begin, bytes)`` that windows cover which stand twice among them.

    Regions of one text that overlap are joined first, so that no place counts as another.
    """
    joined: list[list] = []
    for key, begin, data in sorted(regions, key=lambda r: (r[0], r[1], len(r[2]))):
        if joined and joined[-1][0] == key and begin <= joined[-1][1] + len(joined[-1][2]):
            over = joined[-1][1] + len(joined[-1][2]) - begin
            if over < len(data):
                joined[-1][2] = np.concatenate([joined[-1][2], data[over:]])
        else:
            joined.append([key, begin, data])
    if not joined:
        return []
    s = np.concatenate([np.append(d.astype(np.int64) + 1, 0) for _, _, d in joined])
    match = RunIndex(s).matching_statistics()
    spans, at = [], 0
    for key, begin, data in joined:
        hit = match[at : at + max(0, len(data) - window + 1)] >= window
        edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
        spans += [(key, begin + int(b), begin + int(e) + window - 1) for b, e in edge.reshape(-1, 2)]
        at += len(data) + 1
    return spans


def _pieces(window: int):
    """``key, text, [a, pos, n, ...]`` to the bytes of each stretch."""

    def run(batches):
        seen: set = set()
        for b in batches:
            rows, size = [], 0
            for key, t, at in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                if key in seen:
                    continue
                if len(seen) > 100_000:
                    seen.clear()
                seen.add(key)
                raw = raw_of(t.as_py())
                for a, pos, n in zip(at[::3], at[1::3], at[2::3], strict=True):
                    rows.append((a, key, pos, raw[pos : pos + n + window - 1]))
                    size += n + window
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.int32(), pa.binary()), strict=True)], ["a", "key", "pos", "data"])
                        rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.binary(), pa.int32(), pa.binary()), strict=True)], ["a", "key", "pos", "data"])

    return run


def _index(window: int, batch_bytes: int, large: int):
    """Pieces sorted by anchor to spans ``(key, b, e)``; windows of an anchor with too many bytes come out named instead."""

    def spans(found):
        if found:
            k, b, e = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(k), pa.int64()), pa.array(k, pa.binary()), pa.array(b, pa.int32()), pa.array(e, pa.int32())], ["name", "key", "b", "e"])

    def named(pieces):
        for key, pos, data in pieces:
            first = np.arange(max(0, len(data) - window + 1))
            names = stretch_names(prefix_sums(_BYTE[data]), first, first + window).view(np.int64)
            at = pa.array((first + pos).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([key] * len(first), pa.binary()), at, pa.array((first + pos + window).astype(np.int32))], ["name", "key", "b", "e"])

    def run(batches):
        ready, ready_size = [], 0  # complete anchors
        own, own_size, anchor, over = [], 0, None, False
        for b in batches:
            for a, key, pos, data in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                if a != anchor:
                    ready, ready_size = ready + own, ready_size + own_size
                    own, own_size, anchor, over = [], 0, a, False
                    if ready_size >= batch_bytes:
                        yield from spans(repeated_in(ready, window))
                        ready, ready_size = [], 0
                own.append((key, pos, np.frombuffer(data, np.uint8)))
                own_size += len(data)
                if over or own_size > large:
                    over = True
                    yield from named(own)
                    own, own_size = [], 0
        yield from spans(repeated_in(ready + own, window))

    return run


def repeated_bytes(docs: DataFrame, window: int = 200, text_col: str = "text", batch_bytes: int = BATCH, large: int = LARGE) -> DataFrame:
    """By text key what is lost: ``spans array<int>`` of (begin, end) bytes, or ``whole`` for texts that stand there twice."""
    if window < GRAM + 1:
        raise ValueError(f"window must be over {GRAM}")
    rows = docs.select(text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    spread = F.when(F.col("settled"), F.xxhash64("key", "pos")).otherwise(F.col("a"))
    dealt = rows.mapInArrow(_scan(window), _ROW).repartition(spread).sortWithinPartitions("a", "c", "key", "pos")
    found = durable(dealt.mapInArrow(_settle, _OUT))
    wanted = F.transform(F.collect_set(F.struct("a", "pos", "n")), lambda x: F.array(x["a"], x["pos"].cast("long"), x["n"].cast("long")))
    checks = durable(found.filter("check").groupBy("key").agg(F.flatten(wanted).alias("at")))
    pieces = join_small(rows, checks, ["key"], "inner", salts=1).select("key", "text", "at").mapInArrow(_pieces(window), "a long, key binary, pos int, data binary")
    indexed = pieces.repartition("a").sortWithinPartitions("a", "key", "pos").mapInArrow(_index(window, batch_bytes, large), "name long, key binary, b int, e int")
    indexed = durable(indexed)
    named = indexed.filter("name is not null").withColumn("place", F.xxhash64("key", "b"))
    twice = named.groupBy("name").agg(F.min("place").alias("x"), F.max("place").alias("y")).filter("x < y").select("name")
    spans = (
        found.filter("not check").select("key", F.array(F.col("pos"), F.col("pos") + F.col("n") + (window - 1)).alias("s"))
        .union(indexed.filter("name is null").select("key", F.array("b", "e")))
        .union(named.join(twice, "name").select("key", F.array("b", "e")))
    )
    lost = spans.groupBy("key").agg(F.flatten(F.sort_array(F.collect_set("s"))).alias("spans"))
    copies = rows.groupBy("key").count().filter("count > 1").select("key", F.lit(True).alias("whole"))
    return durable(lost.join(copies, "key", "full").select("key", "spans", F.coalesce("whole", F.lit(False)).alias("whole")))


def kept_bytes(raw: bytes, spans, whole: bool, window: int) -> tuple[int, bytes]:
    """Number of maximal removed runs, and the bytes that stay."""
    if whole and len(raw) >= window:
        return 1, b""
    if spans is None or not len(spans):
        return 0, raw
    out, at, runs = [], -1, 0
    for b, e in np.asarray(spans, np.int64).reshape(-1, 2).tolist():
        if b > at:
            out.append(raw[max(at, 0) : b])
            runs += 1
        at = max(at, e)
    return runs, b"".join(out) + raw[at:]


def dedup_report(docs: DataFrame, window: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: bytes, removed bytes and runs, digest of what stays."""

    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    def digest(texts: pd.Series, spans: pd.Series, whole: pd.Series) -> pd.DataFrame:
        rows = []
        for t, s, w in zip(texts, spans, whole, strict=True):
            raw = raw_of(t)
            runs, kept = kept_bytes(raw, s, w is True, window)
            rows.append((len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), text_key(F.col(text_col)).alias("key"))
    marked = join_small(rows, repeated_bytes(docs, window, text_col), ["key"], "left", salts=1)
    return marked.select(F.col("_id").alias(id_col), digest("_text", "spans", "whole").alias("d")).select(id_col, "d.*")
