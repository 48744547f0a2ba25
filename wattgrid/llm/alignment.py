"""Tokens of two tokenizers set side by side: groups between shared ends, links
of overlapping tokens, and how often each pair of ids is linked."""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from .common import cut, map_arrow

#: Units that a task keeps, the longest of them, and how many are encoded together.
CACHE = 600_000
LONGEST_KEPT = 64
TOGETHER = 2_000
#: Characters of texts that are taken apart together.
APART = 1 << 18


def shared_ends(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Where two rising lists of ends have an end in common, as numbers of ends
    ``(i, j)`` up to it: ``a[i - 1] == b[j - 1]``.  Both end at the same place.

    Divide and conquer: the common end nearest to the middle of an interval is
    located by bisection, then both halves; an interval without one is a leaf."""
    if not a:
        return []
    cuts = [(len(a), len(b))]
    stack = [(0, len(a) - 1, 0, len(b) - 1)] if len(a) > 1 and len(b) > 1 else []
    while stack:
        lo, hi, blo, bhi = stack.pop()  # both not empty; the common end behind them is known
        i = middle = (lo + hi) // 2
        j = bisect_left(b, a[i], blo, bhi)
        step = 0
        while j == bhi or b[j] != a[i]:  # the next one below or above the middle
            step = -step if step > 0 else 1 - step
            i = middle + step
            if not lo <= i < hi:
                step = -step if step > 0 else 1 - step
                i = middle + step
                if not lo <= i < hi:
                    break
            j = bisect_left(b, a[i], blo, bhi)
        else:
            cuts.append((i + 1, j + 1))
            if lo < i and blo < j:
                stack.append((lo, i, blo, j))
            if i + 1 < hi and j + 1 < bhi:
                stack.append((i + 1, hi, j + 1, bhi))
    cuts.sort()
    return cuts


def links_of(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of tokens (as positions) whose byte ranges overlap, by two rising
    lists of ends that start and end at the same place.  A token is linked with
    a run of the other side: from the first that ends behind its start to the
    first that ends at or behind its end."""
    start = np.concatenate([[0], a[:-1]]) if len(a) else a
    first, to = np.searchsorted(b, start, side="right"), np.searchsorted(b, a, side="left") + 1
    counts = to - first
    before = np.cumsum(counts) - counts
    return (np.repeat(np.arange(len(a)), counts),
            np.arange(counts.sum()) + np.repeat(first - before, counts))


@dataclass
class Tokenizers:
    """``a``: JSON of a byte-level BPE tokenizer (``tokenizers``).  ``b``: a
    serialised SentencePiece model that puts a blank before a text."""

    a: str
    b: bytes

    @classmethod
    def load(cls, a_path: str, b_path: str) -> Tokenizers:
        with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
            return cls(f.read(), g.read())


@cache
def byte_letters() -> dict[str, int]:
    """The letters in which byte-level vocabularies write bytes: a printable
    byte of Latin-1 is itself, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Aligner:
    """Aligns texts unit by unit.  A unit starts at a blank or line feed that
    follows a character which is no white space (or at the start).  No token of
    either vocabulary goes over such a place (checked when loading; if one does,
    a text is one unit), so both tokenizers cut there and the place is a shared
    end.  An interval met again need not be solved again: a task keeps a bounded
    number of units, with their figures in columns.

    Units number 0 is one that cannot be aligned."""

    def __init__(self, both: Tokenizers):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(both.a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        letters = byte_letters()
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.a_bytes = [bytes(letters[c] for c in t) if t and all(c in letters for c in t) else (t or "").encode()
                        for t in map(self.a.id_to_token, range(size))]
        self.b = sentencepiece.SentencePieceProcessor(model_proto=both.b)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(self.b.id_to_piece(i) for i in range(self.b.get_piece_size()))]
        self.a_size, self.b_size = (np.array([len(t) for t in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        self.a_shown, self.b_shown = ([np.array([f"{i}{mark}" for i in range(len(side))], object) for mark in marks]
                                      for side, marks in ((self.a_bytes, ",|"), (self.b_bytes, ",;")))
        # A token over a cut, or one that begins with a blank and a line feed.
        over = re.compile(r"\S[ \n]|^ +\n")
        whole = any(over.search(t.decode("utf-8", "replace")) for t in [*self.a_bytes, *self.b_bytes])
        # White space as Python sees it holds what the tokenizers take for it.
        self.units = (lambda t: [t]) if whole else re.compile(
            r"\s*\S+(?:[^\S \n]\s*\S+)*(?:[^\S \n]\s*\Z)?|\s+").findall
        self.blank = self.b.encode("\n")[:1]
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.groups = [""]
        self.n_a, self.n_b, self.n_groups = array("i", [0]), array("i", [0]), array("i", [0])
        # The links of unit u: bounds[u] to bounds[u + 1] of pair, numbers of the
        # distinct pairs (a id << 32 | b id) in pair_key.
        self.bounds, self.pair = array("q", [0, 0]), array("i")
        self.pair_number: dict[int, int] = {}
        self.pair_key = array("q")

    def encode_a(self, text: str) -> list[int]:
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode_b(self, text: str) -> list[int]:
        """``b`` puts a blank before what it gets: a text's own blank is left to
        it; before a line feed that blank is a piece to drop."""
        if text == " ":
            return self.blank
        return self.b.encode(text[1:]) if text.startswith(" ") else self.b.encode(text)[1:]

    def solve(self, units: list[str]) -> bool:
        """Aligns units that are encoded end to end and enters them; false if
        that cannot be done with all of them at once."""
        text = "".join(units)
        ids = self.encode_a(text), self.encode_b(text)
        whole = text.encode()
        if any(b"".join([surface[i] for i in side]) != whole for surface, side in zip((self.a_bytes, self.b_bytes), ids, strict=True)):
            return False
        a, b = (np.array(side, np.int64) for side in ids)
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        a_cuts, b_cuts = np.array(shared_ends(a_ends.tolist(), b_ends.tolist())).T
        stops = np.cumsum([len(u.encode()) for u in units])
        at = np.searchsorted(a_ends[a_cuts - 1], stops)  # the group that ends where a unit ends
        if (a_ends[a_cuts[np.minimum(at, len(a_cuts) - 1)] - 1] != stops).any():
            return False
        x, y = links_of(a_ends, b_ends)
        keys, link = np.unique(a[x] << 32 | b[y], return_inverse=True)
        numbers = [self.pair_number.setdefault(k, len(self.pair_number)) for k in keys.tolist()]
        self.pair_key.extend([k for k, i in zip(keys.tolist(), numbers, strict=True) if i >= len(self.pair_key)])
        self.pair.frombytes(np.array(numbers, np.int32)[link].tobytes())

        # The groups as text: each id with the mark that follows it.
        a_group = np.searchsorted(a_cuts, np.arange(len(a)), side="right")
        b_group = np.searchsorted(b_cuts, np.arange(len(b)), side="right")
        a_last, b_last = np.zeros(len(a), bool), np.zeros(len(b), bool)
        a_last[a_cuts - 1], b_last[b_cuts - 1] = True, True
        shown = np.empty(len(a) + len(b), object)
        b_before = np.concatenate([[0], b_cuts[:-1]])
        shown[np.arange(len(a)) + b_before[a_group]] = np.where(a_last, self.a_shown[1][a], self.a_shown[0][a])
        shown[np.arange(len(b)) + a_cuts[b_group]] = np.where(b_last, self.b_shown[1][b], self.b_shown[0][b])
        parts = shown.tolist()

        def own(ends: np.ndarray) -> bytes:  # how many each unit has
            return np.diff(np.concatenate([[0], ends])).astype(np.int32).tobytes()
        a_stop, b_stop = a_cuts[at], b_cuts[at]
        self.n_a.frombytes(own(a_stop))
        self.n_b.frombytes(own(b_stop))
        self.n_groups.frombytes(own(at + 1))
        self.bounds.frombytes((self.bounds[-1] + np.searchsorted(x, a_stop, side="left")).astype(np.int64).tobytes())
        number, lo = len(self.groups), 0
        for unit, hi in zip(units, (a_stop + b_stop).tolist(), strict=True):
            self.known[unit] = number
            self.groups.append("".join(parts[lo:hi]))
            number, lo = number + 1, hi
        return True

    def learn(self, units: set[str]) -> None:
        new = [u for u in units if u not in self.known]
        # Where a unit ends with a character and the next one starts, both cut.
        joinable = [u for u in new if not u[-1].isspace()]
        alone = [u for u in new if u[-1].isspace()]
        for k in range(0, len(joinable), TOGETHER):
            some = joinable[k:k + TOGETHER]
            if len(some) == 1 or not self.solve(some):
                alone += some
        for u in alone:
            if not self.solve([u]):
                self.known[u] = 0

    def some(self, texts: list[str | None]) -> tuple:
        """Of texts that are taken apart together: how many tokens of each side
        and groups each has, the digests, and ``(pairs, doc, pair, times)``: the
        distinct id pairs, and how often each text has which of them."""
        if len(self.groups) > CACHE:
            self.clear()
        parts = [self.units(" " + t) if t else [] for t in texts]
        units = set().union(*parts)
        self.learn(units)
        known, groups = self.known, self.groups
        numbers = [list(map(known.__getitem__, p)) for p in parts]
        del parts
        numbers = [[] if 0 in p else p for p in numbers]
        for u in units:
            if len(u) > LONGEST_KEPT:
                del known[u]
        digests = [hashlib.sha256("".join(map(groups.__getitem__, p))[:-1].encode()).hexdigest() if p else "" for p in numbers]

        def column(values: array, dtype) -> np.ndarray:
            return np.frombuffer(values, dtype) if len(values) else np.zeros(0, dtype)

        doc = np.repeat(np.arange(len(texts)), [len(p) for p in numbers])
        unit = np.fromiter(chain.from_iterable(numbers), np.int64, len(doc))
        sums = [np.bincount(doc, weights=column(c, np.int32)[unit], minlength=len(texts)).astype(np.int64)
                for c in (self.n_a, self.n_b, self.n_groups)]
        bounds = column(self.bounds, np.int64)
        sizes = bounds[unit + 1] - bounds[unit]
        places = np.arange(sizes.sum()) + np.repeat(bounds[unit] - (np.cumsum(sizes) - sizes), sizes)
        most = len(self.pair_key) or 1
        cells, times = np.unique(np.repeat(doc * most, sizes) + column(self.pair, np.int32)[places], return_counts=True)
        doc, pair = np.divmod(cells, most)
        pairs, pair = np.unique(pair, return_inverse=True)
        return (*sums, digests, column(self.pair_key, np.int64)[pairs], doc, pair, times)

    def block(self, texts: list[str | None]) -> dict:
        """The figures of a block of texts, each with its distinct pairs: numbers
        of pairs (``doc_pair``, from ``doc_bounds`` of a text on) and how often it
        has them (``doc_times``); and the block's distinct pairs with their totals."""
        found, doc, lo, held = [], [], 0, 0
        for hi, text in enumerate(texts, 1):
            held += len(text or "")
            if held >= APART or hi == len(texts):
                found.append(self.some(texts[lo:hi]))
                doc.append(lo + found[-1][5])
                lo, held = hi, 0
        if not texts:
            found, doc = [self.some([])], [np.zeros(0, np.int64)]
        pairs = np.unique(np.concatenate([f[4] for f in found]))
        doc_pair = np.concatenate([np.searchsorted(pairs, f[4])[f[6]] for f in found])
        doc_times = np.concatenate([f[7] for f in found])
        total = np.bincount(doc_pair, weights=doc_times, minlength=len(pairs))
        n_a, n_b, n_groups = (np.concatenate([f[i] for f in found]) for i in range(3))
        return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "groups_sha256": [d for f in found for d in f[3]],
                "doc_bounds": np.searchsorted(np.concatenate(doc), np.arange(len(texts) + 1)), "doc_pair": doc_pair, "doc_times": doc_times,
                "pair_a": pairs >> 32, "pair_b": pairs & 0xFFFFFFFF, "pair_total": total.astype(np.int64)}


_BLOCK = ("n_a long, n_b long, n_groups long, groups_sha256 string, width int, pairs binary, times binary, "
          "pair_a array<int>, pair_b array<int>, pair_total array<long>")


def packed(values: np.ndarray, bounds: np.ndarray, dtype: np.dtype) -> pa.Array:
    """A binary for each run of ``values`` between ``bounds``."""
    values = np.ascontiguousarray(values.astype(dtype))
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * dtype.itemsize).astype(np.int32)), pa.py_buffer(values)])


def align_blocks(docs: DataFrame, both: Tokenizers, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``block`` (the number of the Arrow batch
    it came in, which is bounded in rows and bytes), ``id``, the figures, and its
    pairs and times as whole numbers of ``width`` bytes.  The first row of a block
    also has the block's pairs (``pair_a, pair_b, pair_total``)."""
    shared = docs.sparkSession.sparkContext.broadcast(both)
    kind = StructType([StructField("block", StructType.fromDDL("b long")["b"].dataType),
                       StructField("id", docs.schema[id_col].dataType), *StructType.fromDDL(_BLOCK)])

    def make():
        aligner = Aligner(shared.value)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            got, rows = aligner.block(batch.column(2).to_pylist()), batch.num_rows
            dtype = np.min_scalar_type(max(len(got["pair_a"]), got["doc_times"].max(initial=0)))
            block = pa.array(np.full(rows, batch.column(0)[0].as_py(), np.int64))
            once = pa.array(np.concatenate([[0], np.full(rows, len(got["pair_a"]))]), pa.int32())
            later = pa.array(np.arange(rows) > 0)
            lists = [pa.ListArray.from_arrays(once, pa.array(got[c], k), mask=later)
                     for c, k in (("pair_a", pa.int32()), ("pair_b", pa.int32()), ("pair_total", pa.int64()))]
            return pa.RecordBatch.from_arrays(
                [block, batch.column(1), *(pa.array(got[c]) for c in ("n_a", "n_b", "n_groups")), pa.array(got["groups_sha256"], pa.string()),
                 pa.array(np.full(rows, dtype.itemsize, np.int32)), *(packed(got[c], got["doc_bounds"], dtype) for c in ("doc_pair", "doc_times")),
                 *lists], names=kind.names)
        return each

    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col), F.col(text_col).alias("_text"))
    return map_arrow(rows, make, kind)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``(a, b, n, best)``: how many links hold each pair of ids in the whole
    corpus, and whether no pair of its ``b`` has more."""
    totals = (blocks.where("pair_a is not null").select(F.inline(F.arrays_zip(F.col("pair_a").alias("a"), F.col("pair_b").alias("b"),
                                                  F.col("pair_total").alias("n"))))
              .groupBy("a", "b").agg(F.sum("n").alias("n")))
    return totals.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("b")))


def align(docs: DataFrame, both: Tokenizers, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``
    for every row.

    Both tokenizers cut a blank and the text; places where tokens of both end
    cut these into groups; tokens whose bytes overlap are linked.  ``n_best``:
    links whose pair of ids is the most frequent of its second id in the corpus,
    ties included.  ``count_sum``: the corpus-wide counts of a text's links,
    summed.

    Blocks of rows are aligned and written once, a row for each text and the
    distinct pairs of the block; the pairs (not the texts' links) are counted and
    joined, and the rows of a block meet the counts of its own pairs.  No table of
    all pairs is held in one place.

    Null and empty texts, and texts that a tokenizer's tokens do not give back
    byte by byte, have no tokens: zeros and an empty digest.  A very long text
    is a block of its own.  Repeated rows and ids, also null ids, count each; an
    empty table gives none.  No other column is read, so names cannot clash."""
    blocks = cut(align_blocks(docs, both, id_col, text_col))
    counts = cut(pair_counts(blocks))
    own = blocks.where("pair_a is not null").select("block", F.posexplode(F.arrays_zip(F.col("pair_a").alias("a"), F.col("pair_b").alias("b"))).alias("k", "p"))
    told = own.select(F.col("block").alias("of"), "k", "p.a", "p.b").join(counts, ["a", "b"]).select("of", "k", "n", "best")
    kind = StructType([StructField(id_col, docs.schema[id_col].dataType), *StructType.fromDDL(
        "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")])

    def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Sums of the runs between ``bounds`` (empty runs: 0), whole numbers."""
        return np.diff(np.concatenate([[0], np.cumsum(values)])[bounds])

    def figures(rows: pa.Table, told: pa.Table) -> pa.Table:
        k = told.column("k").to_numpy()
        n, best = np.zeros((2, len(k)), np.int64)
        n[k], best[k] = told.column("n").to_numpy(), told.column("best").to_numpy(zero_copy_only=False)
        width = rows.column("width")[0].as_py() if rows.num_rows else 1
        pair, times = (np.frombuffer(b"".join(rows.column(c).to_pylist()), f"u{width}").astype(np.int64) for c in ("pairs", "times"))
        bounds = np.concatenate([[0], np.cumsum(pc.binary_length(rows.column("pairs")).to_numpy() // width)])
        return pa.table([*(rows.column(c) for c in ("id", "n_a", "n_b", "n_groups")),
                         *(pa.array(sums(v, bounds)) for v in (times, best[pair] * times, n[pair] * times)),
                         rows.column("groups_sha256")], names=kind.names)

    rows = blocks.drop("pair_a", "pair_b", "pair_total")
    return rows.groupBy("block").cogroup(told.groupBy("of")).applyInArrow(figures, kind)
