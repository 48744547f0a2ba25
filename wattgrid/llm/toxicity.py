"""Toxic spans with a linear-chain conditional random field of two states."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, with_id
from .words import LETTERS_DIGITS, LOWER_ASCII, Piece, Words, mix, pieces

BITS = 20
LIMIT = 30.0
COLUMNS = 2048


@dataclass
class Crf:
    """``weights``: by hashed token feature, the score of "toxic" over "clean".
    ``bias``, ``start``: constants of every token and of a first token.
    ``step``: scores of the four transitions.  ``document``: constants of the
    document score."""

    weights: np.ndarray
    bias: float
    start: float
    step: np.ndarray
    document: np.ndarray


def token_features(piece: Piece) -> tuple[Words, np.ndarray]:
    """Words of the piece, and for each the hashes of itself, its first four
    and six bytes, and its neighbours in the same text (0: none)."""
    w = Words(piece, LETTERS_DIGITS, LOWER_ASCII)
    n = len(w)
    left, right = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    if n:
        left[1:], right[:-1] = w.hash[:-1], w.hash[1:]
        starts = w.first[:-1][w.counts > 0]
        left[starts] = 0
        right[w.first[1:][w.counts > 0] - 1] = 0
    kinds = [w.hash, w.prefix(4), w.prefix(6), left, right]
    hashed = [mix(k + np.uint64(i + 1)) >> np.uint64(64 - BITS) for i, k in enumerate(kinds)]
    return w, np.stack(hashed, axis=1).astype(np.int64) if n else np.zeros((0, len(kinds)), np.int64)


def _ratios(gain: np.ndarray, fresh: np.ndarray, enter: float, a: float, b: float, c: float, d: float) -> np.ndarray:
    """r[t] = gain[t] * (a r[t-1] + b) / (c r[t-1] + d), and gain[t] * enter
    where ``fresh``.  Tokens are laid out in columns; the map of a column is a
    product of 2x2 matrices, so the columns run side by side: first their
    products, then the values that enter each column, then the values."""
    n = len(gain)
    if n == 0:
        return np.zeros(0)
    rows = -(-n // COLUMNS)
    g = np.ones(rows * COLUMNS)
    f = np.zeros(rows * COLUMNS, dtype=bool)
    g[:n], f[:n] = gain, fresh
    g, f = np.ascontiguousarray(g.reshape(COLUMNS, rows).T), np.ascontiguousarray(f.reshape(COLUMNS, rows).T)
    p, q, r, s = np.ones(COLUMNS), np.zeros(COLUMNS), np.zeros(COLUMNS), np.ones(COLUMNS)
    for t in range(rows):
        top_p, top_q = g[t] * (a * p + b * r), g[t] * (a * q + b * s)
        low_p, low_q = c * p + d * r, c * q + d * s
        new = f[t]
        top_p, top_q = np.where(new, 0.0, top_p), np.where(new, g[t] * enter, top_q)
        low_p, low_q = np.where(new, 0.0, low_p), np.where(new, 1.0, low_q)
        size = np.maximum(np.maximum(top_p, top_q), np.maximum(low_p, low_q))
        p, q, r, s = top_p / size, top_q / size, low_p / size, low_q / size
    now = np.empty(COLUMNS)
    value = enter
    for k in range(COLUMNS):
        now[k] = value
        value = (p[k] * value + q[k]) / (r[k] * value + s[k])
    out = np.empty((rows, COLUMNS))
    for t in range(rows):
        now = g[t] * np.where(f[t], enter, (a * now + b) / (c * now + d))
        out[t] = now
    return out.T.reshape(-1)[:n]


def marginals(emission: np.ndarray, first: np.ndarray, crf: Crf) -> tuple[np.ndarray, np.ndarray]:
    """Probability of "toxic" for each token, by forward and backward ratios;
    and the expected number of each of the four transitions.  ``first``: bounds
    of the texts' tokens."""
    n = len(emission)
    opens, closes = np.zeros(n, bool), np.zeros(n, bool)
    some = np.diff(first) > 0
    opens[first[:-1][some]] = True
    closes[first[1:][some] - 1] = True
    gain = np.exp(np.clip(emission, -LIMIT, LIMIT))
    t = np.exp(crf.step)
    forward = _ratios(gain, opens, float(np.exp(crf.start)), t[1, 1], t[0, 1], t[1, 0], t[0, 0])
    # Backward ratio times the token's own gain obeys the same kind of law.
    back = _ratios(gain[::-1], closes[::-1], 1.0, t[1, 1], t[1, 0], t[0, 1], t[0, 0])[::-1]
    odds = forward * back / gain
    p = odds / (1 + odds)
    before = np.concatenate([[1.0], forward[:-1]]) if n else forward
    back, before = back[~opens], before[~opens]
    weight = 1.0 / (t[0, 0] + t[0, 1] * back + t[1, 0] * before + t[1, 1] * before * back)
    expected = t * np.array([[weight.sum(), weight @ back], [weight @ before, weight @ (before * back)]])
    return p, expected


def _emission(ids: np.ndarray, crf: Crf) -> np.ndarray:
    return crf.weights[ids].sum(axis=1) + crf.bias


def token_labels(ids: np.ndarray, owner: np.ndarray, toxic: np.ndarray, least: int = 5, lift: float = 30.0) -> np.ndarray:
    """Labels of tokens from labels of texts: in a toxic text a token counts as
    toxic if the word or one of its beginnings stands between at least
    ``least`` different pairs of neighbours in toxic texts, and their number
    per toxic text is ``lift`` times its number per clean text.  Counting
    neighbours, not texts, keeps words clean that toxic texts share only
    because they are copies of each other."""
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    out = np.zeros(len(ids), bool)
    bad = toxic[owner]
    around = mix(ids[:, 3].astype(np.uint64) + (ids[:, 4].astype(np.uint64) << np.uint64(BITS))) >> np.uint64(BITS)

    def spread(k: int, rows: np.ndarray) -> np.ndarray:
        high = np.uint64(64 - BITS)
        places = np.unique((ids[rows, k].astype(np.uint64) << high) | around[rows]) >> high
        return np.bincount(places.astype(np.int64), minlength=1 << BITS)

    for k in range(3):
        c1, c0 = spread(k, bad), spread(k, ~bad)
        out |= ((c1 >= least) & (c1 / n1 >= lift * (c0 + 0.5) / n0))[ids[:, k]]
    return out & bad


def document_features(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each text: 1, the log odds of its most toxic token, and the log of 1
    plus the expected number of toxic tokens among those that are toxic more
    likely than not (the small rest of very many clean tokens would add up in
    long texts).  No token: log odds of -LIMIT."""
    n = len(first) - 1
    some = np.diff(first) > 0
    top, total = np.full(n, -LIMIT), np.zeros(n)
    if some.any():
        at = first[:-1][some]
        best = np.clip(np.maximum.reduceat(p, at), 1e-13, 1 - 1e-13)
        top[some] = np.log(best / (1 - best))
        total[some] = np.add.reduceat(np.where(p >= 0.5, p, 0.0), at)
    return np.stack([np.ones(n), top / 10, np.log1p(total)], axis=1)


def fit(sample: list[tuple[str, int]], rounds: int = 25, l2: float = 1e-4, rate: float = 0.4) -> Crf:
    """From texts and their labels: token labels, then the field by gradient
    steps on its log likelihood (observed less expected counts from the
    forward-backward marginals; Adagrad), then the constants of the document
    score by Newton steps.  No rows: every text scores one half."""
    crf = Crf(np.zeros(1 << BITS), -2.0, 0.0, np.zeros((2, 2)), np.zeros(3))
    if not sample:
        return crf
    ids, bounds = [], [np.zeros(1, np.int64)]
    for piece in pieces(pa.array([t for t, _ in sample], pa.string())):
        w, f = token_features(piece)
        ids.append(f.astype(np.int32))
        bounds.append(w.first[1:] + bounds[-1][-1])
    ids, first = np.concatenate(ids), np.concatenate(bounds)
    toxic = np.array([y for _, y in sample], bool)
    owner = np.repeat(np.arange(len(sample)), np.diff(first))
    label = token_labels(ids, owner, toxic)
    opens = np.zeros(len(ids), bool)
    opens[first[:-1][np.diff(first) > 0]] = True
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[:-1][~opens[1:]].astype(int), label[1:][~opens[1:]].astype(int)), 1)
    squares = {k: 1e-6 for k in ("bias", "start")} | {"w": np.full(1 << BITS, 1e-6), "t": np.full((2, 2), 1e-6)}
    scale = 1.0 / max(1, int(label.sum()))
    columns = [ids[:, k] for k in range(ids.shape[1])]
    for _ in range(rounds):
        p, expected = marginals(_emission(ids, crf), first, crf)
        off = (label - p) * scale
        g = -l2 * crf.weights
        for column in columns:
            g += np.bincount(column, weights=off, minlength=1 << BITS)
        squares["w"] += g * g
        crf.weights += rate * g / np.sqrt(squares["w"])
        for name, value in (("bias", off.sum()), ("start", off[opens].sum())):
            squares[name] += value * value
            setattr(crf, name, getattr(crf, name) + rate * value / np.sqrt(squares[name]))
        g = (seen - expected) * scale - l2 * crf.step
        squares["t"] += g * g
        crf.step = crf.step + rate * g / np.sqrt(squares["t"])
    x = document_features(marginals(_emission(ids, crf), first, crf)[0], first)
    y = toxic.astype(float)
    for _ in range(25):
        q = 1 / (1 + np.exp(-np.clip(x @ crf.document, -LIMIT, LIMIT)))
        h = (x * (q * (1 - q))[:, None]).T @ x + 0.05 * np.eye(3)
        crf.document = crf.document + np.linalg.solve(h, x.T @ (y - q) - 0.05 * crf.document)
    return crf


def score(docs: DataFrame, crf: Crf, span_p: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, score, spans)`` for every row.

    ``score``: 0 to 1, from the marginals of all tokens of the whole text.
    ``spans``: code-point offsets (from, to) of the tokens whose marginal is
    ``span_p`` or more; neighbouring tokens make one span.  Null, empty and
    wordless texts get the score of a text without tokens and no spans.
    Repeated rows are scored each; no other column is read."""
    shared = docs.sparkSession.sparkContext.broadcast(crf)
    span = pa.struct([("from", pa.int32()), ("to", pa.int32())])

    def make():
        model = shared.value

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores, spans = np.empty(batch.num_rows), [[] for _ in range(batch.num_rows)]
            for piece in pieces(batch.column(1)):
                w, ids = token_features(piece)
                p, _ = marginals(_emission(ids, model), w.first, model)
                x = document_features(p, w.first) @ model.document
                scores[piece.first:piece.first + len(piece)] = 1 / (1 + np.exp(-np.clip(x, -LIMIT, LIMIT)))
                hit = np.flatnonzero(p >= span_p)
                if len(hit) == 0:
                    continue
                owner = np.searchsorted(w.first, hit, side="right") - 1
                opens = np.concatenate([[True], (np.diff(hit) > 1) | (np.diff(owner) > 0)])
                closes = np.concatenate([opens[1:], [True]])
                chars = np.concatenate([[0], np.cumsum((piece.data & 0xC0) != 0x80)])
                base = chars[piece.bounds[owner[opens]]]
                for row, a, b in zip(owner[opens], chars[w.start[hit[opens]]] - base,
                                     chars[w.end[hit[closes]]] - base, strict=True):
                    spans[piece.first + row].append({"from": int(a), "to": int(b)})
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array(spans, pa.list_(span))],
                                              names=[id_col, "score", "spans"])
        return each

    return map_arrow(docs.select(F.col(id_col), F.col(text_col).alias("_text")), make,
                     with_id(docs, id_col, "score double, spans array<struct<`from`: int, `to`: int>>"))
