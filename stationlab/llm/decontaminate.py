"""Benchmark decontamination by a distributed positional inverted index.

1. Corpus counts of every benchmark term (one scan of all documents, counted in the tasks, added up by Spark).
2. For every window of an item (``window`` consecutive words, or the whole of a shorter item) its two rarest terms.
3. The index: postings of those terms over all documents, (term, text, position, words around it).
4. Postings move to item positions by subtracting the term's offset; lists of one text and item are intersected on the
   shift: a shift stays where both rarest terms of some window meet. What is left is compared word by word around the
   posting, so matches are exact. :func:`proximity_matches` stops before that and returns near misses too.

Terms of a scan are handed to tasks as a set of at most ``block_terms`` terms; more terms take more scans. Copies of a text
share its key and collapse in the tasks. Null texts have no words; items without words have no windows; repeated items and
rows, null ids and further columns are kept apart or ignored; an empty table gives no hits.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scale import durable
from .common import join_small, text_key

#: Upper case to lower; what is neither letter, digit nor beyond ASCII parts words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def fold_words(text) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if isinstance(text, str) else []


def folded(text: Column) -> Column:
    """Words of a text as an array of strings."""

    @F.pandas_udf("array<string>")
    def words(s: pd.Series) -> pd.Series:
        return pd.Series([[w.decode("utf-8", "surrogatepass") for w in fold_words(t)] for t in s])

    return words(text)


def _texts(b: pa.RecordBatch, col: int = 0) -> Iterator[str | None]:
    for x in b.column(col):
        yield x.as_py()


def _in_blocks(terms: DataFrame, block_terms: int) -> Iterator[frozenset[bytes]]:
    """The distinct ``term`` values in sets of about ``block_terms``."""
    n = terms.count()
    parts = max(1, -(-n // block_terms))
    for k in range(parts if n else 0):
        rows = terms.filter(F.pmod(F.xxhash64("term"), F.lit(parts)) == k).select("term").collect()
        yield frozenset(r.term.encode("utf-8", "surrogatepass") for r in rows)


def _each_block(docs: DataFrame, terms: DataFrame, scan, schema: str, block_terms: int) -> DataFrame:
    out = None
    for some in _in_blocks(terms, block_terms):
        part = docs.mapInArrow(scan(docs.sparkSession.sparkContext.broadcast(some)), schema)
        out = part if out is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def term_counts(docs: DataFrame, terms: DataFrame, block_terms: int = 200_000, text_col: str = "text") -> DataFrame:
    """How often each of ``terms(term)`` occurs in all documents."""

    def scan(some):
        def run(batches):
            count: Counter = Counter()
            for b in batches:
                for t in _texts(b):
                    count.update(filter(some.value.__contains__, fold_words(t)))
            keys = list(count)
            yield pa.RecordBatch.from_pydict({"term": pa.array([k.decode("utf-8", "surrogatepass") for k in keys], pa.string()), "n": pa.array([count[k] for k in keys], pa.int64())})

        return run

    found = _each_block(docs.select(F.col(text_col)), terms, scan, "term string, n long", block_terms)
    return found.groupBy("term").agg(F.sum("n").alias("n"))


def postings(docs: DataFrame, terms: DataFrame, around: int, block_terms: int = 200_000, text_col: str = "text") -> DataFrame:
    """The index: ``(term, key, pos, left, right)`` for each place of a term, with ``around`` words on either side."""

    def scan(some):
        def run(batches):
            seen: set = set()
            out: list = []

            def flush():
                c = list(zip(*out, strict=True))
                out.clear()
                s = [pa.array([x.decode("utf-8", "surrogatepass") for x in c[j]], pa.string()) for j in (0, 3, 4)]
                return pa.RecordBatch.from_arrays([s[0], pa.array(c[1], pa.binary()), pa.array(c[2], pa.int32()), s[1], s[2]], ["term", "key", "pos", "left", "right"])

            for b in batches:
                for key, t in zip(b.column(0).to_pylist(), _texts(b, 1), strict=True):
                    if key in seen:  # a copy: its postings are there already
                        continue
                    seen.add(key)
                    words = fold_words(t)
                    for i in [i for i, w in enumerate(words) if w in some.value]:
                        out.append((words[i], key, i, b" ".join(words[max(0, i - around) : i]), b" ".join(words[i + 1 : i + 1 + around])))
                        if len(out) >= 5_000:  # however many a text or batch has
                            yield flush()
                    if len(seen) > 100_000:
                        seen.clear()
            if out:
                yield flush()

        return run

    keyed = docs.select(text_key(F.col(text_col)).alias("key"), F.col(text_col))
    return _each_block(keyed, terms, scan, "term string, key binary, pos int, left string, right string", block_terms)


def item_windows(items: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """Each item window's two rarest terms: ``(item, start, off1, off2)``, offsets counted from the item's first word.

    A window with a single word has it twice. Windows with a term that no document has are left out.
    """
    place = items.select("item", F.posexplode("words").alias("off", "term")).join(counts, "term", "left")
    starts = F.sequence(F.greatest(F.lit(0), F.col("off") - (window - 1)), F.least(F.col("off"), F.greatest(F.lit(0), F.col("len") - window)))
    sized = place.join(items.select("item", F.size("words").alias("len")), "item")
    each = sized.select("item", "off", F.explode(starts).alias("start"), F.coalesce("n", F.lit(0)).alias("n"))
    # a window has at most ``window`` rows
    ordered = each.groupBy("item", "start").agg(F.sort_array(F.collect_list(F.struct("n", "off"))).alias("o"))
    some = ordered.filter(F.col("o")[0]["n"] > 0)
    return some.select("item", "start", F.col("o")[0]["off"].alias("off1"), F.coalesce(F.get("o", F.lit(1)), F.col("o")[0])["off"].alias("off2"))


def shifted_lists(docs: DataFrame, items: DataFrame, window: int, block_terms: int, text_col: str = "text") -> DataFrame:
    """Intersected posting lists: ``(key, item, shift, hits array<struct<off, left, right>>, words)``.

    ``shift`` is the document position of the item's first word. Only shifts where both rarest terms of a window stand are left.
    """
    terms = items.select(F.explode("words").alias("term")).distinct()
    windows = durable(item_windows(items, term_counts(docs, terms, block_terms, text_col), window))
    anchors = durable(
        windows.select("item", F.explode(F.array("off1", "off2")).alias("off")).distinct().join(items, "item").select("item", "off", F.col("words")[F.col("off")].alias("term"))
    )
    index = durable(postings(docs, durable(anchors.select("term").distinct()), window - 1, block_terms, text_col))
    moved = join_small(index, anchors, ["term"], "inner").withColumn("shift", F.col("pos") - F.col("off"))
    # collect_set, so that copies of a text are merged in each task before the shuffle; a set has one entry for an anchor
    lists = moved.groupBy("key", "item", "shift").agg(F.collect_set(F.struct("off", "left", "right")).alias("hits"))
    pairs = windows.groupBy("item").agg(F.collect_set(F.struct("off1", "off2")).alias("pairs"))
    both = F.exists("pairs", lambda p: F.array_contains(F.col("hits.off"), p["off1"]) & F.array_contains(F.col("hits.off"), p["off2"]))
    table = durable(pairs.join(items, "item"))
    return join_small(lists, table, ["item"], "inner").filter(both).select("key", "item", "shift", "hits", "words")


def item_words(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item, item_id, words)``; ``item`` tells items with equal ids and different texts apart. Items without words are left out."""
    w = items.select(F.col(id_col).cast("string").alias("item_id"), folded(F.col(text_col)).alias("words")).filter(F.size("words") > 0).distinct()
    return durable(w.withColumn("item", F.unhex(F.md5(F.concat(F.coalesce("item_id", F.lit("?")), F.lit(" "), F.array_join("words", " "))))))


def exact_matches(docs: DataFrame, items: DataFrame, window: int = 13, block_terms: int = 200_000, text_col: str = "text", item_id: str = "item_id") -> DataFrame:
    """Stretches of documents that item windows cover: ``(key, item_id, begin, end)`` in words, end excluded."""
    known = item_words(items, item_id)
    found = shifted_lists(docs, known.select("item", "words"), window, block_terms, text_col)
    hit = found.select("key", "item", "shift", "words", F.explode("hits").alias("h")).select("key", "item", "shift", "words", "h.*")

    def run(theirs, mine):
        """Length of the common beginning of two word arrays."""
        differs = F.filter(F.sequence(F.lit(0), F.size(theirs)), lambda i: F.coalesce(F.get(theirs, i) != F.get(mine, i), F.lit(True)))
        return F.array_min(differs)

    words_of = lambda c: F.filter(F.split(c, " "), lambda w: w != "")
    n = F.size("words")
    left = run(F.reverse(words_of("left")), F.reverse(F.slice("words", F.greatest(F.col("off") - window + 2, F.lit(1)), F.least(F.col("off"), F.lit(window - 1)))))
    right = run(words_of("right"), F.slice("words", F.col("off") + 2, F.lit(window - 1)))
    at = F.col("shift") + F.col("off")
    spans = hit.select("key", "item", (at - left).alias("begin"), (at + right + 1).alias("end"), F.least(n, F.lit(window)).alias("need"))
    return spans.filter(F.col("end") - F.col("begin") >= F.col("need")).join(known.select("item", "item_id"), "item").select("key", "item_id", "begin", "end").distinct()


def proximity_matches(docs: DataFrame, items: DataFrame, window: int = 13, block_terms: int = 200_000, text_col: str = "text", item_id: str = "item_id") -> DataFrame:
    """Texts and items where both rarest terms of a window keep their distance, whatever stands between: ``(key, item_id, shift)``."""
    known = item_words(items, item_id)
    found = shifted_lists(docs, known.select("item", "words"), window, block_terms, text_col)
    return found.join(known.select("item", "item_id"), "item").select("key", "item_id", "shift").distinct()



def text_hits(matches: DataFrame) -> DataFrame:
    """By text: covered words, number and list of items. The stretches of a text are merged in order of their begin."""
    w = Window.partitionBy("key").orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.max("end").over(w), F.lit(0))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("begin"), seen))
    spans = matches.select("key", "begin", "end").distinct().withColumn("fresh", fresh).groupBy("key").agg(F.sum("fresh").cast("long").alias("n_hit"))
    ids = matches.groupBy("key").agg(F.sort_array(F.collect_set(F.coalesce("item_id", F.lit("")))).alias("items"))
    return durable(spans.join(ids, "key"))


def contamination(docs: DataFrame, items: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", block_terms: int = 200_000) -> DataFrame:
    """One row per document: words, hit words, items found, and whether at least a twentieth of the words is hit."""

    @F.pandas_udf("long")
    def count_words(s: pd.Series) -> pd.Series:
        return pd.Series([len(fold_words(t)) for t in s], dtype="int64")

    hits = text_hits(exact_matches(docs, items, window, block_terms, text_col, item_id))
    sized = docs.select(F.col(id_col), text_key(F.col(text_col)).alias("key"), count_words(text_col).alias("n_words"))
    out = join_small(sized, hits, ["key"], "left").withColumn("n_hit", F.coalesce("n_hit", F.lit(0)).cast("long"))
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        id_col, "n_words", "n_hit", F.size(items_).cast("long").alias("n_items"), F.sha2(F.array_join(items_, ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), items_.alias("items"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = 13, text_col: str = "text", item_id: str = "item_id") -> DataFrame:
    """The documents that are not contaminated, as they are."""

    @F.pandas_udf("long")
    def count_words(s: pd.Series) -> pd.Series:
        return pd.Series([len(fold_words(t)) for t in s], dtype="int64")

    hits = text_hits(exact_matches(docs, items, window, 200_000, text_col, item_id)).select("key", "n_hit")
    rows = docs.select(F.struct(*docs.columns).alias("_row"), text_key(F.col(text_col)).alias("key"))
    marked = join_small(rows, hits, ["key"], "left")
    n_words = count_words(F.when(F.col("n_hit") > 0, F.col(f"_row.{text_col}")))
    return marked.withColumn("n_words", n_words).filter("n_hit is null or 20 * n_hit < n_words").select("_row.*")
