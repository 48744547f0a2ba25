"""Quality classifier: hashed word n-grams, follow-the-regularised-leader."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, with_id
from .words import Piece, Words, join_hashes, mix, pieces

BITS = 18
SCALE = 20.0

#: Kinds of bytes: 1 letters, digits and non-ASCII, 2 other printable ASCII.
KINDS = np.zeros(256, dtype=np.uint8)
KINDS[33:127] = 2
KINDS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def features(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of each text and their bounds: words (punctuation runs
    are words), pairs of words, and one to three words seen only as their
    outline (kind, capitals, digits, length up to four)."""
    w = Words(piece, KINDS)
    capital = np.concatenate([[0], np.cumsum((w.data >= 65) & (w.data <= 90))])
    digit = np.concatenate([[0], np.cumsum((w.data >= 48) & (w.data <= 57))])
    size = w.end - w.start
    caps, digits = capital[w.end] - capital[w.start], digit[w.end] - digit[w.start]
    outline = (KINDS[w.data[w.start]] * 64 + np.minimum(size, 4) * 8
               + np.where(caps == 0, 0, np.where(caps * 2 > size, 2, 1)) * 2 + (digits > 0)).astype(np.uint64)
    outline = mix(outline + np.uint64(1))
    first, n = w.first, len(w)
    texts = w.text
    out, owner = [], []
    for salt, hashes, k in ((1, w.hash, 1), (2, w.hash, 2), (3, outline, 1), (4, outline, 2), (5, outline, 3)):
        grams = join_hashes(hashes, k) + np.uint64(salt)
        if len(grams) == 0:
            continue
        same = texts[:len(grams)] == texts[k - 1:n]
        out.append((mix(grams) >> np.uint64(64 - BITS))[same].astype(np.int64))
        owner.append(texts[:len(grams)][same])
    if not out:
        return np.zeros(0, np.int64), np.zeros(len(first), np.int64)
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(out)[order], np.searchsorted(owner[order], np.arange(len(first)))


class Ftrl:
    """Logistic regression with one learning rate per weight and L1 / L2 terms
    (FTRL-proximal)."""

    def __init__(self, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, at: np.ndarray, x: np.ndarray, label: float) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -30, 30)))
        g = (p - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def fit(sample: list[tuple[str, int]], epochs: int = 3) -> np.ndarray:
    """Weights (the last one is the constant) from ``(text, label)`` rows in
    the given order; no rows: all weights 0."""
    model = Ftrl()
    rows = []
    for piece in pieces(pa.array([t for t, _ in sample], pa.string())):
        ids, bounds = features(piece)
        for i in range(len(piece)):
            at, count = np.unique(ids[bounds[i]:bounds[i + 1]], return_counts=True)
            x = count * (SCALE / max(1, count.sum()))
            rows.append((np.append(at, 1 << BITS), np.append(x, 1.0), float(sample[piece.first + i][1])))
    for _ in range(epochs):
        for row in rows:
            model.update(*row)
    return model.weights()


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, score)`` for every row: the sigmoid of the sparse dot product
    of the whole text's n-gram shares with the weights.  Null and empty texts
    have no n-grams, so their score is that of the constant alone.  Repeated
    rows are scored each; no other column is read."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def make():
        w = shared.value

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = np.empty(batch.num_rows)
            for piece in pieces(batch.column(1)):
                ids, bounds = features(piece)
                sums = np.concatenate([[0.0], np.cumsum(w[ids])])
                n = np.diff(bounds)
                out[piece.first:piece.first + len(piece)] = (
                    w[-1] + SCALE * (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(n, 1))
            out = 1 / (1 + np.exp(-np.clip(out, -30, 30)))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], names=[id_col, "score"])
        return each

    return map_arrow(docs.select(F.col(id_col), F.col(text_col).alias("_text")), make, with_id(docs, id_col, "score double"))
