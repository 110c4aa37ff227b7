"""Language identification with a byte convolutional network trained in numpy.

Bytes are embedded, filters of several widths run over fixed-length windows, the maximum of each filter over a window
goes to a softmax. Whole texts are read: windows overlap by the widest filter less one byte, so every byte group is seen
once, and a text's probabilities are its windows' means weighted by bytes.

Null texts and texts without a letter are ``und`` with score 0. Empty tables give no rows; with no labelled row
everything is ``und``. Ids, sources and labels are never inputs of a prediction.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

UNDETERMINED = "und"


@dataclass
class ByteNet:
    labels: list[str]
    width: int  # of the widest filter
    length: int  # of a window
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @property
    def step(self) -> int:
        return self.length - self.width + 1

    def patches(self, x: np.ndarray) -> np.ndarray:
        """Embedded byte groups of ``width`` at every place of the windows ``x``: (windows, places, width * depth)."""
        e = self.p["emb"][x]
        n, _, d = e.shape
        s = e.strides
        return np.ascontiguousarray(np.lib.stride_tricks.as_strided(e, (n, self.step, self.width * d), (s[0], s[1], s[2])))

    def pooled(self, x: np.ndarray, want_places: bool = False):
        u = self.patches(x)
        z = (u.reshape(-1, u.shape[2]) @ self.p["conv"]).reshape(len(x), self.step, -1)
        if not want_places:
            return np.maximum(z.max(axis=1) + self.p["bias"], 0)
        at = z.argmax(axis=1)
        return np.maximum(np.take_along_axis(z, at[:, None, :], 1)[:, 0] + self.p["bias"], 0), at, u

    def softmax(self, h: np.ndarray) -> np.ndarray:
        z = h @ self.p["out"] + self.p["out_bias"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def cut(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Windows of a text, the last one filled with zero bytes, and how many places of each are real."""
        n = max(1, -(-max(1, len(raw) - self.width + 1) // self.step))
        b = np.zeros(n * self.step + self.width - 1, np.uint8)
        b[: len(raw)] = np.frombuffer(raw, np.uint8)
        x = np.lib.stride_tricks.as_strided(b, (n, self.length), (self.step, 1))
        weight = np.full(n, self.step, np.float64)
        weight[-1] = max(1, len(raw) - (n - 1) * self.step)
        return x, weight

    def predict(self, texts: list[str | None], block: int = 64) -> list[tuple[str, float]]:
        """(label, score) of each text, scores to six digits; at most ``block`` windows are in work at a time."""
        sums = np.zeros((len(texts), len(self.labels)))
        wait: list[tuple[int, np.ndarray, np.ndarray]] = []
        ready = 0

        def work():
            x = np.concatenate([w[1] for w in wait])
            of = np.repeat([w[0] for w in wait], [len(w[1]) for w in wait])
            prob = self.softmax(self.pooled(x)) * np.concatenate([w[2] for w in wait])[:, None]
            np.add.at(sums, of, prob)
            wait.clear()

        for i, t in enumerate(texts):
            if t is None or not self.labels or not has_letter(t):
                continue
            x, weight = self.cut(t.encode("utf-8", "surrogatepass"))
            for k in range(0, len(x), block):
                wait.append((i, x[k : k + block], weight[k : k + block]))
                ready += len(wait[-1][1])
                if ready >= block:
                    work()
                    ready = 0
        if wait:
            work()
        out = []
        for row in sums:
            total = row.sum()
            best = int(row.argmax()) if total else -1
            out.append((self.labels[best], round(float(min(1.0, row[best] / total)), 6)) if total else (UNDETERMINED, 0.0))
        return out


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def train(samples: list[tuple[str, str]], widths: tuple[int, ...] = (2, 3, 4), filters: int = 12, depth: int = 8, length: int = 256, epochs: int = 6, seed: int = 11) -> ByteNet:
    """Fit a network on (label, text) pairs: Adam on the cross entropy, the gradient passing through each filter's maximum."""
    labels = sorted({y for y, _ in samples})
    rng = np.random.default_rng(seed)
    k, n_f = max(widths), filters * len(widths)
    net = ByteNet(labels, k, length)
    mask = np.zeros((k, depth, n_f), np.float32)
    for j, w in enumerate(widths):
        mask[:w, :, j * filters : (j + 1) * filters] = 1
    mask = mask.reshape(k * depth, n_f)
    net.p = {
        "emb": rng.normal(0, 0.5, (256, depth)).astype(np.float32), "conv": (rng.normal(0, 0.3, (k * depth, n_f)) * mask).astype(np.float32),
        "bias": np.zeros(n_f, np.float32), "out": rng.normal(0, 0.3, (n_f, max(1, len(labels)))).astype(np.float32), "out_bias": np.zeros(max(1, len(labels)), np.float32),
    }
    net.p["emb"][0] = 0
    xs, ys = [], []
    for y, t in samples:
        raw = t.encode("utf-8", "surrogatepass")
        # as it is, and a short piece, so that short texts are known too
        for piece in (raw[:length], raw[(a := int(rng.integers(0, max(1, len(raw) - 8)))) : a + int(rng.integers(8, 96))]):
            if piece:
                xs.append(net.cut(piece)[0][0])
                ys.append(labels.index(y))
    if not xs:
        net.labels = []
        return net
    xs, ys = np.stack(xs), np.array(ys)
    share = np.bincount(ys, minlength=len(labels)) / len(ys)
    m = {n: np.zeros_like(v) for n, v in net.p.items()}
    v = {n: np.zeros_like(w) for n, w in net.p.items()}
    step, batch = 0, 64
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs)
        for ids in np.array_split(rng.permutation(len(xs)), max(1, len(xs) // batch)):
            x, y = xs[ids], ys[ids]
            h, at, u = net.pooled(x, want_places=True)
            prob = net.softmax(h)
            prob[np.arange(len(y)), y] -= 1
            g = (prob * (1 / (share[y] * len(labels) * len(y)))[:, None]).astype(np.float32)
            gh = (g @ net.p["out"].T) * (h > 0)
            best = u[np.arange(len(x))[:, None], at]
            gu = gh[:, :, None] * net.p["conv"].T[None]  # (windows, filters, width * depth)
            ge = np.zeros_like(net.p["emb"])
            places = x[np.arange(len(x))[:, None, None], at[:, :, None] + np.arange(k)]
            np.add.at(ge, places, gu.reshape(*gu.shape[:2], k, depth))
            ge[0] = 0
            grads = {"emb": ge, "conv": np.einsum("nf,nfd->df", gh, best) * mask, "bias": gh.sum(0), "out": h.T @ g, "out_bias": g.sum(0)}
            step += 1
            for n, gr in grads.items():
                m[n] = 0.9 * m[n] + 0.1 * gr
                v[n] = 0.99 * v[n] + 0.01 * gr * gr
                net.p[n] = (net.p[n] - rate * (m[n] / (1 - 0.9**step)) / (np.sqrt(v[n] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def fit_language(labelled: DataFrame, per_label: int = 300, pieces: int = 4, piece_chars: int = 400, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> ByteNet:
    """Train on a bounded sample of labelled rows: about ``per_label`` rows of each label, chosen by id hash, and
    ``pieces`` stretches of at most ``piece_chars`` characters from anywhere in each."""
    rows = labelled.filter(F.col(label_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    sizes = {r[0]: r[1] for r in rows.groupBy(label_col).count().collect()}
    if not sizes:
        return ByteNet([], 4, 256)
    place = F.pmod(F.xxhash64(F.lit("place"), id_col), F.lit(1_000_000)) / 1e6
    limit = F.create_map(*[F.lit(x) for y, n in sorted(sizes.items()) for x in (y, min(1.0, per_label / n))])[F.col(label_col)]
    room = F.greatest(F.length(text_col) - piece_chars, F.lit(0)) + 1

    def piece(i):
        return F.substring(F.col(text_col), (F.pmod(F.xxhash64(F.lit("piece"), id_col, i), room) + 1).cast("int"), F.lit(piece_chars))

    got = rows.filter(place < limit).select(F.col(id_col).alias("i"), F.col(label_col).alias("y"), F.array(*[piece(F.lit(i)) for i in range(pieces)]).alias("t")).collect()
    return train([(r.y, t) for r in sorted(got, key=lambda r: (str(r.y), str(r.i), r.t)) for t in dict.fromkeys(r.t) if has_letter(t)])


def language_of(net: ByteNet, text: Column) -> Column:
    """struct<lang_pred, score> of a text."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(net.predict([t if isinstance(t, str) else None for t in texts]), columns=["lang_pred", "score"])

    return predict(text)
