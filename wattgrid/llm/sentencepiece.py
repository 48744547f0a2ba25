"""Segmentation into the pieces of a SentencePiece model, and back.

The automaton of all pieces reports, at each position, every piece that ends
there; one pass keeps the best score of each position."""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, with_id

CACHE = 300_000
LONGEST_KEPT = 64


@dataclass
class Pieces:
    """``table``: (piece, id, score), with a blank for the mark of word starts.
    ``bytes``: ids of the 256 bytes.  ``surface``: bytes that each id stands
    for.  ``prefix``: whether a blank is put before a text."""

    table: list[tuple[str, int, float]]
    bytes: list[int]
    surface: list[bytes]
    prefix: bool

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        table, own, surface = [], [0] * 256, []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                own[value] = i
                surface.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                surface.append(b"")
            else:
                text = piece.replace("▁", " ")
                table.append((text, i, model.get_score(i)))
                surface.append(text.encode())
        return cls(table, own, surface, model.encode("a", out_type=str)[0].startswith("▁"))


class Segmenter:
    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.automaton = ahocorasick.Automaton()
        for text, i, score in pieces.table:
            self.automaton.add_word(text, (i, len(text), score))
        self.automaton.make_automaton()
        # A character without a piece costs more than the worst rare piece.
        self.miss = min(0.0, *(s for _, _, s in pieces.table if s > -1e8)) - 10.0
        # No piece goes on past a blank that follows another character, nor
        # over characters that no piece has: texts fall apart there.
        alphabet = set().union(*(t for t, _, _ in pieces.table))
        inner = any(" " in t.lstrip(" ") for t, _, _ in pieces.table)
        lone = "".join(c for c in "\n\r\t" if c not in alphabet)
        self.parts = (lambda t: [t]) if inner else re.compile(f" *[^ {lone}]+| +|[{lone}]" if lone else " *[^ ]+| +").findall
        self.kept: dict[str, bytes] = {}

    def best(self, text: str) -> list[int]:
        """Ids of the segmentation with the highest total score.  Equal scores:
        the piece that ends first in the automaton's order (the longest)."""
        n = len(text)
        score = [0.0] + [-float("inf")] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        filled = 0
        miss = self.miss
        for end, (i, size, value) in self.automaton.iter(text):
            while filled <= end:
                score[filled + 1] = score[filled] + miss
                filled += 1
            got = score[end + 1 - size] + value
            if got > score[end + 1]:
                score[end + 1] = got
                back[end + 1] = (size, i)
        out: list[int] = []
        at = n
        while at:
            size, i = back[at]
            if i >= 0:
                out.append(i)
                at -= size
            else:
                out.extend(self.pieces.bytes[b] for b in reversed(text[at - 1].encode()))
                at -= 1
        out.reverse()
        return out

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        kept, out = self.kept, []
        if len(kept) > CACHE:
            kept.clear()
        for part in self.parts((" " if self.pieces.prefix else "") + text):
            got = kept.get(part)
            if got is None:
                got = np.array(self.best(part), np.int32).tobytes()
                if len(part) <= LONGEST_KEPT:
                    kept[part] = got
            out.append(got)
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        surface = self.pieces.surface
        raw = b"".join([surface[i] for i in ids.tolist()])
        if self.pieces.prefix and raw.startswith(b" "):
            raw = raw[1:]
        return raw.decode("utf-8", errors="replace")


def encode(docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_tokens, ids, round_trip)`` for every row.

    ``ids``: the best segmentation of the whole text (characters without a
    piece as their UTF-8 bytes, also the mark of word starts itself, so that
    nothing is lost).  ``round_trip``: decoding ``ids`` gives the text back.
    Null text: null ids, 0 tokens, round_trip null.  Empty text: no ids, true.
    Repeated rows are encoded each; no other column is read."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def make():
        segmenter = Segmenter(shared.value)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, counts, same = [], [], []
            for text in batch.column(1).to_pylist():
                got = None if text is None else segmenter.encode(text)
                ids.append(got)
                counts.append(0 if got is None else len(got))
                same.append(None if got is None else segmenter.decode(got) == text)
            bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            values = np.concatenate([g for g in ids if g is not None] or [np.zeros(0, np.int32)])
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(values, pa.int32()),
                                             mask=pa.array([g is None for g in ids]))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), lists, pa.array(same, pa.bool_())],
                                              names=[id_col, "n_tokens", "ids", "round_trip"])
        return each

    return map_arrow(docs.select(F.col(id_col), F.col(text_col).alias("_text")), make,
                     with_id(docs, id_col, "n_tokens long, ids array<int>, round_trip boolean"))


def decode(rows: DataFrame, pieces: Pieces, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(id_col, text)``: the texts that lists of ids stand for (null: null)."""
    shared = rows.sparkSession.sparkContext.broadcast(pieces)

    def make():
        segmenter = Segmenter(shared.value)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [None if i is None else segmenter.decode(np.array(i, np.int32)) for i in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])
        return each

    return map_arrow(rows.select(F.col(id_col), F.col(ids_col)), make, with_id(rows, id_col, "text string"))
