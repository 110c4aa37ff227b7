"""Quality rules by distribution divergence.

Every document's histogram over character classes and over its language's most common words is held against the
language's own, taken over all documents, by Jensen-Shannon distance (base 2, 0 to 1). Documents shorter than a guard are
not judged by that histogram. Plain counts (symbols, repeated lines and word windows) come first.

Null texts have no words and fail the base rule; a null language is a language of its own; repeated rows count as often
as they stand there; empty tables give no rows. The references hold a fixed number of words for each language.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import mixed

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
#: Classes of a byte: lower, upper, digit, white space, sentence marks, other ASCII, first byte of any other character; 7 is not counted.
_CLASS = np.full(256, 5, np.uint8)
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", SPACES.encode(), b".,;:!?'\"-()")):
    _CLASS[list(_chars)] = _k
_CLASS[0x80:0xC0] = 7
_CLASS[0xC0:] = 6
N_CLASSES = 7
#: Lower case; what is neither letter, digit nor beyond ASCII parts words.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def raw_bytes(text) -> bytes:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def common_words(raw: bytes) -> list[bytes]:
    return raw.translate(_WORDS).split()


def class_counts(raw: bytes) -> np.ndarray:
    return np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=8)[:N_CLASSES]


def repeated_words(words: list[bytes], size: int = 5) -> int:
    """Words inside windows of ``size`` words that stand in the text twice or more."""
    if len(words) <= size:
        return 0
    ids: dict[bytes, int] = {}
    x = mixed(np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.uint64, len(words)) + np.uint64(1))
    n = len(words) - size + 1
    key = np.zeros(n, np.uint64)
    for k in range(size):
        key = mixed(key * np.uint64(31) + x[k : k + n])
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(key, twice))
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return int((np.cumsum(edge) > 0).sum())


def base_counts(text) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    if not isinstance(text, str):
        return 0, 0, 0, 0, 0
    words = raw_bytes(text).split()
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms; an empty one is at distance 1."""
    if not p.sum() or not q.sum():
        return 1.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum() / 2 + np.where(q > 0, q * np.log2(q / m), 0).sum() / 2
    return float(np.sqrt(min(1.0, max(0.0, d))))


def _partial_counts(batches: Iterator[pa.RecordBatch], flush: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Counts of a task: rows (language, word, n), classes as words of one byte below 8. Handed on in bounded parts."""
    words: Counter = Counter()

    def part():
        keys = list(words)
        return pa.RecordBatch.from_pydict({"_lang": [k[0] for k in keys], "_word": pa.array([k[1] for k in keys], pa.binary()), "_n": pa.array(list(words.values()), pa.int64())})

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            raw = raw_bytes(text.as_py())
            for k, n in enumerate(class_counts(raw).tolist()):
                if n:
                    words[lang, bytes([k])] += n
            own = Counter(common_words(raw))
            words[lang, b"\x07"] += own.total()
            for w, n in own.items():
                words[lang, w] += n
            if len(words) > flush:
                yield part()
                words.clear()
    if words:
        yield part()


def language_references(docs: DataFrame, top: int = 50, text_col: str = "text", lang_col: str = "lang") -> dict:
    """By language: its class histogram, its ``top`` words and their counts with all others last."""
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("?")).alias("_lang"), F.col(text_col).alias("_text"))
    counts = rows.mapInArrow(_partial_counts, "_lang string, _word binary, _n long").groupBy("_lang", "_word").agg(F.sum("_n").alias("_n"))
    special = (F.length("_word") == 1) & (F.col("_word") <= F.lit(b"\x07"))
    rank = F.row_number().over(Window.partitionBy("_lang", "_special").orderBy(F.desc("_n"), "_word"))
    got = counts.withColumn("_special", special).withColumn("_k", rank).filter(F.col("_k") <= max(top, N_CLASSES + 1)).collect()
    out: dict = {}
    for r in sorted(got, key=lambda r: (r["_lang"], r["_k"])):
        ref = out.setdefault(r["_lang"], {"classes": np.zeros(N_CLASSES), "words": {}, "n": [], "total": 0})
        w = bytes(r["_word"])
        if not r["_special"]:
            if len(ref["words"]) < top:
                ref["words"][w] = len(ref["words"])
                ref["n"].append(r["_n"])
        elif w == b"\x07":
            ref["total"] = r["_n"]
        else:
            ref["classes"][w[0]] = r["_n"]
    for ref in out.values():
        ref["hist"] = np.array([*ref["n"], ref["total"] - sum(ref["n"])], float)
    return out


def judge_quality(docs: DataFrame, max_class_distance: float = 0.2, max_word_distance: float = 0.5, min_chars: int = 200, min_words: int = 40, top: int = 50, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: the counts, both distances (null below their guard), ``base_failed`` and ``kept``."""
    refs = language_references(docs, top, text_col, lang_col)

    @F.pandas_udf("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, class_distance double, word_distance double")
    def measure(langs: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = []
        for lang, text in zip(langs, texts, strict=True):
            base, raw = base_counts(text), raw_bytes(text)
            ref, near, far = refs.get(lang), None, None
            if ref and len(raw) >= min_chars:
                near = js_distance(class_counts(raw).astype(float), ref["classes"])
            if ref and len(words := common_words(raw)) >= min_words:
                index, other = ref["words"], len(ref["words"])
                far = js_distance(np.bincount([index.get(w, other) for w in words], minlength=other + 1).astype(float), ref["hist"])
            rows.append((*base, near, far))
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance"]
        return pd.DataFrame(rows, columns=names).astype({"class_distance": float, "word_distance": float})

    m = docs.select(F.col(id_col), measure(F.coalesce(F.col(lang_col), F.lit("?")), F.col(text_col)).alias("m")).select(id_col, "m.*")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    near = F.coalesce(F.nanvl(F.col("class_distance"), F.lit(None)) <= max_class_distance, F.lit(True))
    far = F.coalesce(F.nanvl(F.col("word_distance"), F.lit(None)) <= max_word_distance, F.lit(True))
    return m.withColumn("base_failed", failed).withColumn("kept", ~failed & near & far)
