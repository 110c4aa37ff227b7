"""Spelling variants of a vocabulary: words at one inserted, deleted or replaced code point, by variable-length grams.

A word stands between two marks. The gram dictionary holds all grams of two code points and, up to ``LONGEST``, every
extension of a gram that is frequent: found at more than a ``SHARE`` of the words, so the frequent grams are bounded
(each word has fewer starts than code points, and a task knows them all). From each place of a word starts the shortest
dictionary gram that is not frequent, or the longest there is; a gram depends on nothing outside of itself.

An edit changes the grams that cover its place, so at most as many as any one place of the word is under: the word's
affected-gram bound. Of two near words all other grams are the same, at the same distance from the beginning or from the
end. So if a word is filed under its rarest grams, one more than its bound, two near words meet in a list (of gram, place
and length). A word that has no gram beyond its bound is also filed by its length alone, where such words meet.

Lists are merged in one pass over the sorted postings. In
a list of up to ``PAIRS`` words the pairs are verified one by one, in a longer one through the words' forms without one
code point, which takes time in proportion to the list and to what is found. Both verify exactly.

A null word is no word; repeated words are one (the first count in their order is not defined: give distinct words); an
empty vocabulary gives no rows; a very long word takes time in proportion to its length for each of its lists; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..functions.scale import durable

#: Fixed value: a run of letters.
LETTERS = r"[A-Za-zÀ-ÿ]+"
#: Marks around a word; a word that holds them is treated like any other.
BEGIN, END = "\x01", "\x02"
SHORTEST, LONGEST = 2, 5
#: A gram is frequent beyond this share of the words and beyond FEW of them.
SHARE, FEW = 1 / 2000, 32
#: Lists of more words are verified by forms.
PAIRS = 24
LOT = 50_000


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_count: int = 5, damage: int | None = 199) -> DataFrame:
    """``(word, n)``: the runs of letters with A-Z in lower case that have ``min_length`` code points and ``min_count`` places.

    With ``damage`` a run loses a code point first where that number divides the crc32 of ``id:run``. A null text has no
    runs; a null id counts as the empty text. Tasks count before anything is shuffled, so frequent words do not meet.
    """
    low = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    runs = docs.select(ident.alias("_id"), F.explode(F.regexp_extract_all(low, F.lit(LETTERS), F.lit(0))).alias("_run"))
    run, word = F.col("_run"), F.col("_run")
    # a run of this length cannot become a word
    runs = runs.filter(F.length(run) >= min_length)
    if damage:
        h = F.crc32(F.concat(F.col("_id"), F.lit(":"), run))
        at = (h % F.length(run)).cast("int")
        word = F.when(h % damage == 0, F.overlay(run, F.lit(""), at + 1, F.lit(1))).otherwise(run)
    counted = runs.select(word.alias("word")).filter(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= min_count)


def frequent_grams(words: DataFrame, n_words: int) -> dict[str, int]:
    """Grams of less than ``LONGEST`` code points at more places than the share of ``n_words`` allows, with their counts."""
    w = F.concat(F.lit(BEGIN), F.col("word"), F.lit(END))
    starts = F.sequence(F.lit(1), F.length(w) - SHORTEST + 1)
    sizes = F.array(*[F.lit(q) for q in range(SHORTEST, LONGEST)])
    grams = F.flatten(F.transform(starts, lambda i: F.transform(F.filter(sizes, lambda q: i + q - 1 <= F.length(w)), lambda q: F.substring(w, i, q))))
    limit = max(FEW, SHARE * n_words)
    found = words.select(F.explode(grams).alias("gram")).groupBy("gram").count().filter(F.col("count") > limit)
    return {r[0]: r[1] for r in found.collect()}


def decompose(word: str, frequent: dict[str, int]) -> list[tuple[int, str]]:
    """The grams of a word with their starts in the marked word."""
    w = BEGIN + word + END
    out = []
    for i in range(len(w) - SHORTEST + 1):
        q = SHORTEST
        while q < LONGEST and i + q < len(w) and w[i : i + q] in frequent:
            q += 1
        out.append((i, w[i : i + q]))
    return out


def affected_bound(grams: list[tuple[int, str]]) -> int:
    """How many grams one edit can change: the most that cover one place."""
    change = [0] * (len(grams) + LONGEST + 1)
    for i, g in grams:
        change[i] += 1
        change[i + len(g)] -= 1
    most = now = 0
    for c in change:
        now += c
        most = max(most, now)
    return most


def _postings(word: str, frequent: dict[str, int]) -> set[int]:
    """The lists that a word is in, as hashes of (length of the list's shorter words, place, gram)."""
    grams = decompose(word, frequent)
    bound = affected_bound(grams)
    # rare first; grams that are not in the dictionary's inner part count as equally rare, longer ones first
    ranked = sorted((frequent.get(g, 0), -len(g), g, i) for i, g in grams)[: bound + 1]
    n = len(word)
    lists = [(n, i, g) for _, _, g, i in ranked] + [(n - 1, i - d, g) for _, _, g, i in ranked for d in (0, 1)]
    if len(grams) <= bound:
        lists += [(n, -9, ""), (n - 1, -9, "")]
    return {xxhash.xxh64_intdigest(f"{m}:{i}:{g}".encode("utf-8", "surrogatepass")) - (1 << 63) for m, i, g in lists}


def _one_edit(a: str, b: str) -> bool:
    """Whether exactly one edit leads from ``a`` to ``b``, which is as long or one longer."""
    i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] and a != b if len(a) == len(b) else a[i:] == b[i + 1 :]


def near_in_list(members: dict[str, int]) -> Iterator[tuple[str, str]]:
    """All near pairs of a list, each once or more, whose lengths differ by one at most."""
    if len(members) <= PAIRS:
        for a, b in combinations(members, 2):
            if len(a) > len(b):
                a, b = b, a
            if len(b) - len(a) <= 1 and _one_edit(a, b):
                yield a, b
        return
    forms: dict[tuple[int, str], list[str]] = {}
    for w in members:
        for i in range(len(w)):
            rest = w[:i] + w[i + 1 :]
            if rest in members:
                yield rest, w
            forms.setdefault((i, rest), []).append(w)
    for group in forms.values():
        yield from combinations(group, 2)


def near_pairs(words: DataFrame) -> DataFrame:
    """``(a, a_n, b, b_n)``: every pair of near words of a stored ``words(word, n)`` once, with their counts."""
    words = words.select("word", "n").filter("word is not null")
    frequent = frequent_grams(words, words.count())

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = [], []
            for k, word in enumerate(batch.column(0).to_pylist()):
                lists = _postings(word, frequent)
                keys.extend(lists)
                rows.extend([k] * len(lists))
                if len(keys) >= LOT:
                    at = pa.array(rows)
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), batch.column(0).take(at), batch.column(1).take(at)], ["list", "word", "n"])
                    keys, rows = [], []
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), batch.column(0).take(at), batch.column(1).take(at)], ["list", "word", "n"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, members, found = None, {}, []

        def settle():
            if len(members) > 1:
                for a, b in near_in_list(members):
                    a, b = (a, b) if a < b else (b, a)
                    found.append((a, members[a], b, members[b]))

        def out():
            rows = list(dict.fromkeys(found))
            found.clear()
            cols = zip(*rows, strict=True) if rows else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64()) * 2, strict=True)], ["a", "a_n", "b", "b_n"])

        for batch in batches:
            for key, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != now:
                    settle()
                    now, members = key, {}
                    if len(found) >= LOT:
                        yield out()
                members[word] = n
        settle()
        yield out()

    filed = words.mapInArrow(file, "list long, word string, n long")
    return filed.repartition("list").sortWithinPartitions("list").mapInArrow(merge, "a string, a_n long, b string, b_n long").distinct()


def variant_forms(words: DataFrame, ratio: int = 5) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of a stored vocabulary ``words(word, n)``.

    The form of a word is its near word of the largest count (ties: the first in code-point order) if that is ``ratio``
    times its own or more; the root is the last of its forms. Counts rise by ``ratio`` from form to form, so roots are
    found in a few rounds of doubled steps.
    """
    pairs = durable(near_pairs(words))
    ways = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).union(pairs.select("b", "a", "a_n"))
    # the largest count, then the smallest word: bytes of UTF-8 are in code-point order
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    grouped = ways.groupBy("word").agg(F.count("*").alias("n_near"), best)
    told = words.select("word", "n").filter("word is not null").join(grouped, "word", "left")
    ample = -F.col("best.less") >= ratio * F.col("n")
    told = durable(
        told.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(ample, F.col("best.near")).alias("form"),
            F.when(ample, -F.col("best.less")).cast("long").alias("form_n"),
        )
    )
    step = durable(told.filter("form is not null").select("word", F.col("form").alias("root")))
    while True:
        on = step.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        further = durable(step.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        step = further.drop("_moved")
        if not further.filter("_moved").limit(1).count():
            break
    return told.join(step, "word", "left").withColumn("root", F.coalesce("root", "word"))
