"""Plain versions of the corpus operators, for small tables only."""

import hashlib
import re
from collections import defaultdict

import xxhash

SPACED = re.compile("[^\x20\x09-\x0d]+")
FOLDED = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return SPACED.findall(t or "")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def sha(b):
    return hashlib.sha256(b).hexdigest()


def fingerprint(t):
    w = words(lower(t))
    if not w:
        return 0
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps):
    """Root of each position; roots are the smallest positions."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(fps):
        for j in range(i):
            if (x ^ fps[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def word_repeats(rows, window=50):
    """(id, text) rows to kept words; a null id is the largest."""
    rank = lambda i: (i is None, i or 0)
    first = {}
    for i, t in rows:
        w = words(t)
        for j in range(len(w) - window + 1):
            k = tuple(w[j : j + window])
            first[k] = min(first.get(k, rank(i)), rank(i))
    out = []
    for i, t in rows:
        w = words(t)
        cut = set()
        for j in range(len(w) - window + 1):
            if first[tuple(w[j : j + window])] < rank(i):
                cut.update(range(j, j + window))
        out.append((i, len(w), [x for k, x in enumerate(w) if k not in cut]))
    return out


def byte_repeats(rows, window=200):
    count = defaultdict(int)
    for _, t in rows:
        b = (t or "").encode()
        for j in range(len(b) - window + 1):
            count[b[j : j + window]] += 1
    out = []
    for i, t in rows:
        b = (t or "").encode()
        cut = [False] * len(b)
        for j in range(len(b) - window + 1):
            if count[b[j : j + window]] > 1:
                cut[j : j + window] = [True] * window
        kept = bytes(x for x, c in zip(b, cut, strict=True) if not c)
        spans = sum(c and not p for c, p in zip(cut, [False, *cut], strict=False))
        out.append((i, len(b), len(b) - len(kept), spans, sha(kept)))
    return out


def contamination(rows, items, window=13):
    wins = defaultdict(set)
    for i, t in items:
        w = FOLDED.findall(lower(t))
        if w:
            n = min(window, len(w))
            for j in range(len(w) - n + 1):
                wins[tuple(w[j : j + n])].add("" if i is None else str(i))
    sizes = {len(k) for k in wins}
    out = []
    for i, t in rows:
        w, hit, found = FOLDED.findall(lower(t)), set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if k := wins.get(tuple(w[j : j + n])):
                    hit.update(range(j, j + n))
                    found |= k
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found)).encode()), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def quality_base(t):
    w = words(t)
    at = defaultdict(list)
    for j in range(len(w) - 4):
        at[tuple(w[j : j + 5])].append(j)
    rep = {k for js in at.values() if len(js) > 1 for j in js for k in range(j, j + 5)}
    lines = [x for x in (t or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(rep)
