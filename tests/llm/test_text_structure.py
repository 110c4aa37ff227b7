"""Spelling variants, conversation repair and url filters beside plain versions."""

import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationlab.functions.scale import durable
from stationlab.llm import repair, spelling, url_filter


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_forms(counts, ratio=5):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], counts.get(form[w]), root))
    return sorted(out)


def forms_of(spark, counts):
    words = durable(spark.createDataFrame(list(counts.items()), "word string, n long"))
    return sorted(tuple(r) for r in spelling.variant_forms(words).select("word", "n", "n_near", "form", "form_n", "root").collect())


@pytest.mark.parametrize(("letters", "low", "high", "pairs"), [("ab", 1, 9, 24), ("abé", 1, 6, 0), ("abcdefg", 6, 8, 10**9), ("xyÿ", 5, 12, 2)])
def test_forms_of_random_words(spark, monkeypatch, letters, low, high, pairs):
    monkeypatch.setattr(spelling, "PAIRS", pairs)
    monkeypatch.setattr(spelling, "FEW", 5)
    rng = random.Random(high)
    words = {"".join(rng.choices(letters, k=rng.randint(low, high))) for _ in range(250)}
    words |= {w[:2] + rng.choice(letters) + w[2:] for w in list(words)[:80]}
    counts = {w: rng.choice([5, 6, 25, 30, 125, 700, 3500]) for w in sorted(words)}
    assert forms_of(spark, counts) == plain_forms(counts)


def test_forms_of_few_words(spark):
    assert forms_of(spark, {}) == []
    counts = {"a": 1, "": 7, "b": 5, "\x01\x02": 3, "\x02": 15, "😀x": 2, "😀": 90, "z" * 3000: 5, "z" * 2999: 40}
    assert forms_of(spark, counts) == plain_forms(counts)


def test_bound_holds_for_every_edit():
    rng = random.Random(3)
    words = ["".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(300)]
    grams = Counter(g for w in words for q in (2, 3, 4) for g in [(spelling.BEGIN + w + spelling.END)[i : i + q] for i in range(len(w) + 3 - q)])
    frequent = {g: c for g, c in grams.items() if c > 40}
    assert frequent
    for w in words:
        mine = spelling.decompose(w, frequent)
        for i in range(len(w)):
            for v in (w[:i] + "b" + w[i + 1 :], w[:i] + w[i + 1 :], w[:i] + "c" + w[i:]):
                if v == w:
                    continue
                left, right = set(spelling.decompose(v, frequent)), {(j - len(v), g) for j, g in spelling.decompose(v, frequent)}
                lost = sum((j, g) not in left and (j - len(w), g) not in right for j, g in mine)
                assert lost <= spelling.affected_bound(mine)


def test_counted_words(spark):
    texts = ["Abcdef abcdef ABCDEF xyzxyz, Straße×straße", None, "", "abcdef " * 40 + "shorty Éabcde éabcde", "longest" * 20000, "abcdef"]
    rows = [(k if k != 5 else None, t, "x") for k, t in enumerate(texts * 60)]
    rows = [(None if i is None else i, t, x) for i, t, x in rows]
    expect = Counter()
    for i, t, _ in rows:
        for run in spelling_runs(t or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            expect[low if h % 199 else low[: h % len(low)] + low[h % len(low) + 1 :]] += 1
    got = spelling.count_words(spark.createDataFrame(rows, "doc_id long, text string, word string"))
    assert {r.word: r.n for r in got.collect()} == {w: n for w, n in expect.items() if len(w) >= 6 and n >= 5}


def spelling_runs(text):
    import re

    return re.findall("[A-Za-zÀ-ÿ]+", text)


# conversation repair


def plain_least(codes, doomed, cut):
    """Cost and least audit by trying everything, longest way first: a table over rows and states of whole audits."""
    n, far = len(codes), (10**9, "")
    ends = [(0, ""), far, far, (0, "")]

    def filled(best):
        for _ in range(3):
            best = [min(best[s], (best[repair.GIVE_TO[s]][0] + 2, "I" + best[repair.GIVE_TO[s]][1])) for s in range(4)]
        return best

    best = filled(ends)
    for i in range(n - 1, -1, -1):
        row = []
        for s in range(4):
            ways = [(best[s][0] + 3, "D" + best[s][1])]
            if not doomed[i]:
                to = repair.GIVE_TO[s]
                ways.append((best[to][0] + 2 + cut[i], "R" + best[to][1]))
                if (to := repair.KEEP_TO[s][codes[i]]) >= 0:
                    ways.append((best[to][0] + cut[i], "K" + best[to][1]))
            row.append(min(ways))
        best = filled(row)
    return best[0]


def test_every_short_conversation():
    cases = [c for n in range(5) for c in product(range(4), repeat=n)]
    rng = np.random.default_rng(5)
    sizes = np.array([len(c) for c in cases])
    codes = np.array([x for c in cases for x in c], np.int64)
    doomed, cut = rng.random(len(codes)) < 0.2, rng.random(len(codes)) < 0.3
    costs, audits = repair.least_audits(codes, doomed, cut, sizes)
    at = np.cumsum(sizes) - sizes
    for k, c in enumerate(cases):
        here = slice(at[k], at[k] + len(c))
        assert (costs[k], audits[k]) == plain_least(c, doomed[here], cut[here])


def test_shortest_edits_are_legal():
    """All edit strings of two rows, tried one by one."""
    for codes in product(range(4), repeat=2):
        costs, audits = repair.least_audits(np.array(codes), np.zeros(2, bool), np.zeros(2, bool), np.array([2]))
        found = []
        for n in range(7):
            for edits in product("DIKR", repeat=n):
                if sum(e != "I" for e in edits) != 2:
                    continue
                state, i, cost = 0, 0, 0
                for e in edits:
                    if e == "K":
                        state = repair.KEEP_TO[state][codes[i]] if state >= 0 else -1
                    elif e in "RI":
                        state = repair.GIVE_TO[state] if state >= 0 else -1
                    cost += {"D": 3, "I": 2, "K": 0, "R": 2}[e]
                    i += e != "I"
                if state in (0, 3):
                    found.append((cost, "".join(edits)))
        assert (costs[0], audits[0]) == min(found)


def plain_repair(rows):
    """Rows of one conversation, in order, to its counts, audit and repaired lines."""
    seen, faults = set(), []
    for _, role, text in rows:
        end = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        faults.append("b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    codes = [{"s": 1, "u": 2, "a": 3}.get(r[:1], 0) for _, r, _ in rows]
    cost, audit = plain_least(codes, [f in ("b", "d") for f in faults], [f == "t" for f in faults])
    turns = {t for t, _, _ in rows if t is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit)


def test_damaged_conversations(spark, monkeypatch):
    monkeypatch.setattr(repair, "LOT", 50)
    rng = random.Random(8)
    rows = []
    for c in [None, *range(60)]:
        n = 700 if c == 7 else rng.randint(1, 9)
        for t in range(n):
            rows.append((c, None if rng.random() < 0.05 else t, rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(["Yes.", "No", " \n", None, "a?", "é…", "w" * 5000 + "."]), t))
    rows += rows[:20]
    expect = {}
    for c, t, role, text, _ in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        held = expect.setdefault(c, [])
        if kind:
            text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
            held += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, cost int")
    got = {r.conv_id: r for r in repair.repair_conversations(repair.damage(df)).collect()}
    assert got.keys() == expect.keys()
    for c, held in expect.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        r = got[c]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == plain_repair(held)
        initials = "".join(x.role[:1] for x in r.repaired)
        assert initials.lstrip("s") == "ua" * (len(initials) // 2) and initials.count("s") <= 1
        assert sum(a in "KRI" for a in r.audit) == len(r.repaired)


def test_repair_without_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert repair.repair_conversations(spark.createDataFrame([], schema)).collect() == []
    gone = spark.createDataFrame([(1, 0, "user", "x", True)], schema + ", gone boolean")
    assert [tuple(r) for r in repair.repair_conversations(gone).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", [])]


# url filters


def plain_judge(url, rules):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    end = min([k for k in map(rest.find, "/?#") if k >= 0], default=len(rest))
    host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
    path = path[: min([k for k in map(path.find, "?#") if k >= 0], default=len(path))]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[3], max(fits)[4]) if fits else (host, path, None, "allow")


URLS = [
    None, "", "no scheme", "http://", "http://COM", "http://com/", "HTTP://A.Com/x?y://z", "x://www.Example.com/en/1#a", "https://example.com/en", "http://w.example.com/en/é",
    "http://a.net/es/?q", "http://net/fr/", "http://anet/fr/", "http://.com/", "http://com./", "http://e.com?/en/", "http://example.com/EN/", "a://b://c.com/", "http://x.com\n/en/",
    "http://" + "a." * 20000 + "com/" + "b/" * 20000, "http://ÄB.com/en/",
]
CONTRACT = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


@pytest.mark.parametrize("bits", [4, 8])
def test_judged_urls(spark, monkeypatch, bits):
    monkeypatch.setattr(url_filter, "BITS", bits)
    rng = random.Random(bits)
    part = lambda: "".join(rng.choices("ab", k=rng.randint(1, 3)))
    many = [(".".join(part() for _ in range(rng.randint(1, 3))), "/" + part(), rng.choice(["allow", "block"])) for _ in range(400)]
    urls = URLS + [f"http://{'.'.join(part() for _ in range(rng.randint(1, 4)))}/{part()}" for _ in range(1500)]
    for rules in (CONTRACT, many):
        pages = spark.createDataFrame([(k % 1000, u, "x", "y") for k, u in enumerate(urls)], "page_id long, url string, rule string, host string")
        got = url_filter.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
        expect = [(k % 1000, *plain_judge(u, rules)) for k, u in enumerate(urls)]
        key = lambda r: (r[0], r[1], r[2])
        assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(expect, key=key)


def test_cascade_tells_listed_from_all_others(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "BITS", 4)
    universe = spark.range(6000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = spark.range(0, 9000, 3).select(F.concat(F.lit("k"), "id").alias("key"))
    cascade = url_filter.build_cascade(listed.union(listed), universe)
    assert len(cascade.levels) >= 3
    h1, h2 = url_filter.hashes_of(F.col("key"))
    rows = universe.union(listed).select("key", h1.alias("h1"), h2.alias("h2")).toPandas()
    told = cascade.listed(rows.h1.to_numpy(), rows.h2.to_numpy())
    assert [int(k[1:]) % 3 == 0 for k in rows.key] == told.tolist()


def test_cascade_without_keys(spark):
    none = spark.createDataFrame([], "key string")
    assert url_filter.build_cascade(none, none).levels == []
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    assert [tuple(r) for r in url_filter.judge_urls(pages, rules).collect()] == [(1, "a", "/b", None, "allow")]
    assert url_filter.judge_urls(pages.limit(0), spark.createDataFrame(CONTRACT, rules.schema)).collect() == []
    with pytest.raises(ValueError):
        url_filter.judge_urls(pages, spark.createDataFrame([("a", "/", "deny")], rules.schema))
