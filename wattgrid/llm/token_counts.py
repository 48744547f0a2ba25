"""Token counts from counts of distinct pre-tokens."""

from __future__ import annotations

import os
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, with_id

CACHE = 400_000


class PieceCounter:
    """Tokens of texts under a word-level BPE tokenizer (``tokenizers`` JSON)
    whose pre-tokens are split by the pattern below after NFC, blank folding
    and lower-casing; each distinct pre-token goes through the merges once."""

    # Letters, numbers and blanks up to U+017F, and the
    # tokenizer's own split pattern written with them.
    LETTERS = "a-zA-ZªµºÀ-ÖØ-öø-ſ"
    NUMBERS = "0-9²³¹¼-¾"
    BLANKS = "\\t-\\r \u0085 "
    #: Outside these a text takes the tokenizer's own normalizer and splitter.
    OTHER = re.compile("[^\u0000-įı-ſ]")

    def __init__(self, json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(json)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{self.LETTERS}]+|[{self.NUMBERS}]"
                                f"|[^{self.BLANKS}{self.LETTERS}{self.NUMBERS}]+").findall
        self.plain: dict[str, int] = {}
        self.mapped: dict[str, int] = {}

    def frequencies(self, text: str) -> tuple[Counter, bool]:
        """How often each pre-token occurs; whether they are byte-mapped."""
        if self.OTHER.search(text) is None:
            return Counter(self.split(text.lower())), False
        t = self.tokenizer
        pairs = t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(text))
        return Counter(p for p, _ in pairs), True

    def learn(self, tokens: set[str], mapped: bool) -> dict[str, int]:
        """Piece counts of all ``tokens``, those not yet known counted now."""
        known = self.mapped if mapped else self.plain
        if len(known) > CACHE:
            known.clear()
        new = [t for t in tokens if t not in known]
        if mapped:
            known.update((t, len(self.tokenizer.model.tokenize(t))) for t in new)
        elif new:
            known.update(zip(new, (len(e.ids) for e in self.tokenizer.encode_batch_fast(
                new, add_special_tokens=False)), strict=True))
        return known

    def count(self, texts: list[str]) -> list[int]:
        out, waiting = [0] * len(texts), []
        for i, text in enumerate(texts):
            if any(s in text for s in self.special):
                out[i] = len(self.tokenizer.encode(text, add_special_tokens=False).ids)
            elif text:
                waiting.append((i, *self.frequencies(text)))
        for mapped in (False, True):
            rows = [(i, f) for i, f, m in waiting if m == mapped]
            if rows:
                known = self.learn(set().union(*(f for _, f in rows)), mapped)
                for i, f in rows:
                    out[i] = sum(n * known[t] for t, n in f.items())
        return out


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_bytes, n_tokens)`` for every row.

    Each batch splits its texts into pre-token frequencies, sends every
    distinct pre-token that the task has not met yet through the merges, joins
    its piece count to the frequencies and sums; ids are not kept.  Special
    strings in a text count as the tokenizer counts them by default.  Null text
    counts as empty (0, 0).  Repeated rows count each; no other column is read.

    The tokenizer file (a few MB) is read on the driver and sent to the tasks."""
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def make():
        counter = PieceCounter(shared.value)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counter.count(batch.column(1).to_pylist()), pa.int64())],
                names=[id_col, "n_bytes", "n_tokens"])
        return each

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), text.alias("_text"), F.octet_length(text).cast("long").alias("_n"))
    return map_arrow(rows, make, with_id(docs, id_col, "n_bytes long, n_tokens long"))
