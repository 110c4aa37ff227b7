"""Toxicity by non-negative positive-unlabelled learning, in numpy.

Confirmed toxic texts are the positives, texts of unknown label the unlabelled set. The risk is the class-prior-corrected
estimate ``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))`` with the logistic loss; where the second part turns negative
its gradient is turned round, which keeps a flexible model from fitting the positives only. Features are the presence of
words whose share among positives and unlabelled texts differs clearly.

Null and empty texts are scored by the intercept alone. Without positives, as in empty tables, every score is the prior.
Labels, ids and other columns are never inputs of a score, whatever their names; repeated labels of a document count once,
toxic if one says so. Every word that passes is a feature. A very long text is read whole; it is its set of words.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .quality import common_words, raw_bytes


@dataclass
class ToxicModel:
    words: dict[bytes, int]
    weights: np.ndarray
    intercept: float

    def score(self, raw: bytes) -> float:
        hit = set(self.words).intersection(common_words(raw)) if self.words else ()
        z = self.intercept + sum(self.weights[self.words[w]] for w in hit)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


class Presence:
    """Which of ``words`` each text has, by the pairs that occur: memory follows the texts, not texts times words."""

    def __init__(self, texts: list[bytes], words: dict[bytes, int]):
        found = [sorted(words[w] for w in words.keys() & set(s.split())) for s in texts]
        self.shape = (len(texts), len(words))
        self.row = np.repeat(np.arange(len(texts)), [len(f) for f in found])
        self.col = np.fromiter((c for f in found for c in f), np.int64, len(self.row))

    def __len__(self) -> int:
        return self.shape[0]

    def scores(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.col], minlength=self.shape[0])

    def sums(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, weights=g[self.row], minlength=self.shape[1])


def nonnegative_fit(xp: Presence, xu: Presence, prior: float, steps: int = 1500, rate: float = 0.05, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights and intercept of the linear model that minimizes the non-negative risk, by full-batch Adam."""
    d = xp.shape[1]
    w = np.zeros(d + 1)
    w[d] = np.log(prior / (1 - prior))
    m, v = np.zeros(d + 1), np.zeros(d + 1)

    def add(x, g):  # gradient of a mean over rows
        return np.append(x.sums(g), g.sum()) / max(1, len(x))

    for t in range(1, steps + 1):
        zp, zu = xp.scores(w[:d]) + w[d], xu.scores(w[:d]) + w[d]
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        g_neg = add(xu, su) - prior * add(xp, sp)
        g = prior * add(xp, sp - 1) + g_neg if negative >= 0 else -g_neg
        g[:d] += decay * w[:d]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:d], float(w[d])


def train(positive: list[bytes], unlabelled: list[bytes], prior: float, min_docs: int = 3, min_z: float = 4.0) -> ToxicModel:
    """Choose words by the z score of their document shares, then fit. A sample is its distinct words, joined by spaces."""
    np_, nu = len(positive), len(unlabelled)
    prior = float(min(0.9, max(0.001, prior)))
    if not np_ or not nu:
        return ToxicModel({}, np.zeros(0), float(np.log(prior / (1 - prior))))
    seen = Counter(w for s in positive for w in s.split())
    cp = {w: a for w, a in seen.items() if a >= min_docs}
    del seen
    cu = Counter(w for s in unlabelled for w in s.split() if w in cp)
    scored = []
    for w, a in cp.items():
        b = cu.get(w, 0)
        share = (a + b) / (np_ + nu)
        z = (a / np_ - b / nu) / np.sqrt(max(1e-12, share * (1 - share) * (1 / np_ + 1 / nu)))
        if z >= min_z:
            scored.append((-z, w))
    words = {w: i for i, (_, w) in enumerate(sorted(scored))}
    weights, intercept = nonnegative_fit(Presence(positive, words), Presence(unlabelled, words), prior)
    return ToxicModel(words, weights, intercept)


def fit_toxicity(texts: DataFrame, labels: DataFrame, max_positive: int = 3000, max_unlabelled: int = 6000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicModel:
    """Fit on at most ``max_positive`` confirmed toxic rows and about ``max_unlabelled`` rows taken without their labels.

    Both are chosen by id hash. The class prior is the toxic share of all given labels. Only the distinct words of the
    sample reach the driver.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_y")).filter("_y is not null and _id is not null").groupBy("_id").agg(F.max("_y").alias("_y"))
    n, n_toxic = known.agg(F.count("*"), F.coalesce(F.sum((F.col("_y") == 1).cast("int")), F.lit(0))).first()
    place = F.pmod(F.xxhash64(F.lit("toxic"), "_id"), F.lit(1_000_000)) / 1e6
    chosen = known.filter((F.col("_y") == 1) & (place < min(1.0, max_positive / max(1, n_toxic)))).select("_id").orderBy(F.xxhash64("_id")).limit(max_positive)

    @F.pandas_udf("binary")
    def word_set(s: pd.Series) -> pd.Series:
        return pd.Series([b" ".join(sorted(set(common_words(raw_bytes(t))))) for t in s], dtype=object)

    rows = texts.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).filter("_text is not null")
    pos = rows.join(F.broadcast(chosen), "_id").select("_id", word_set("_text").alias("w")).collect()  # chosen is bounded by max_positive
    un = rows.filter(place < min(1.0, max_unlabelled / max(1, texts.count()))).select("_id", word_set("_text").alias("w")).collect()

    def sets(got):
        return [bytes(r.w) for r in sorted(got, key=lambda r: (str(r["_id"]), r.w))]

    return train(sets(pos), sets(un), n_toxic / n if n else 0.5)


def toxicity_of(model: ToxicModel, text: Column) -> Column:
    """Score of a text, 0 to 1."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(raw_bytes(t)) for t in texts], dtype=float)

    return score(text)
