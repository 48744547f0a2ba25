"""Removal of strings that occur more than once in a corpus, found with suffix
arrays.

A suffix array of the whole corpus would not fit a task, so the corpus is
first cut into contexts that meet where they can share a string.  In every
string of ``width`` bytes the gram (of ``gram`` bytes) with the least hash is
its anchor; equal strings have equal anchors.  The strings that start one
after the other and share an anchor position form a context.  Only contexts of
anchors that occur at least twice matter.  Contexts that occur twice as a whole
consist of repeated strings; the others are suffix-sorted together with all
different contexts of their anchor, and neighbours with a common prefix of
``width`` bytes are repeated strings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import cut, map_arrow
from .suffixes import repeated_starts
from .words import Piece, mix, pieces, prefix_hash

BATCH_BYTES = 1 << 19


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values."""
    n = len(x) - width + 1
    pad = np.concatenate([x, np.full(-len(x) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    left = np.minimum.accumulate(pad, axis=1).ravel()
    right = np.minimum.accumulate(pad[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


def contexts(piece: Piece, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """For each context: hash of the anchor, hash of the context's bytes, text
    it is in, first start within the text, and number of starts."""
    data, bounds = piece.data, piece.bounds
    n = len(data)
    if n < width:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    sums, down = prefix_hash(data)
    grams = mix((sums[gram:] - sums[:n - gram + 1]) * down[:n - gram + 1])
    least = _sliding_min(grams, width - gram + 1)
    starts = len(least)
    new = np.ones(starts, bool)
    # Another anchor, or the anchor's place has just been passed.
    new[1:] = (least[1:] != least[:-1]) | (grams[:starts - 1] == least[:-1])
    new[bounds[:-1][bounds[:-1] < starts]] = True
    last = np.maximum(bounds[1:] - width + 1, bounds[:-1])   # end of the starts of each text
    edge = np.zeros(n + 1, np.int8)
    np.add.at(edge, bounds[:-1], 1)
    np.add.at(edge, last, -1)
    valid = np.cumsum(edge[:starts]) > 0
    at = np.flatnonzero(new & valid)
    text = np.searchsorted(bounds, at, side="right") - 1
    end = np.minimum(np.append(at[1:], starts), last[text])
    whole = mix((sums[end + width - 1] - sums[at]) * down[at])
    return least[at], whole, text, at - bounds[text], end - at


def _occurrences(rows: DataFrame, width: int, gram: int) -> DataFrame:
    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            parts = []
            for piece in pieces(batch.column(1)):
                a, c, text, lo, size = contexts(piece, width, gram)
                parts.append((a.view(np.int64), c.view(np.int64), keys[piece.first + text], lo.astype(np.int32), size.astype(np.int32)))
            columns = [np.concatenate(p) for p in zip(*parts, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "c", "k", "lo", "size"])
        return each
    return map_arrow(rows, make, "a long, c long, k long, lo int, size int")


def _extract(rows: DataFrame, width: int) -> DataFrame:
    """Rows ``(k, _text, need)`` to one row per needed context, with its bytes;
    contexts of crowded anchors as one row per string instead, with a hash."""
    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            out: list[tuple] = []
            for k, text, need in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                raw = text.as_buffer().to_pybytes() if need else b""
                for c in need:
                    part = raw[c["lo"]:c["lo"] + c["size"] + width - 1]
                    if c["crowded"]:
                        sums, down = prefix_hash(np.frombuffer(part, np.uint8))
                        strings = mix((sums[width:] - sums[:-width]) * down[:c["size"]]).view(np.int64)
                        out.extend((c["a"], c["n"], k, c["lo"] + i, None, s) for i, s in enumerate(strings.tolist()))
                    else:
                        out.append((c["a"], c["n"], k, c["lo"], part, None))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                              names=["a", "n", "k", "lo", "part", "string"])
        return each
    return map_arrow(rows, make, "a long, n long, k long, lo int, part binary, string long")


def _suffix_spans(rows: DataFrame, width: int) -> DataFrame:
    """Repeated stretches ``(k, s, e)`` of the contexts that occur once, from
    suffix arrays over whole groups of contexts (sorted by anchor)."""
    def run(batches):
        held: list[tuple] = []
        size, anchor = 0, None

        def spans():
            marks = repeated_starts([h[3] for h in held], width)
            k, s, e = [], [], []
            for (n, key, lo, _), hit in zip(held, marks, strict=True):
                if n > 1 or not hit.any():
                    continue
                edges = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
                for a, b in edges.reshape(-1, 2).tolist():
                    k.append(key)
                    s.append(lo + a)
                    e.append(lo + b - 1 + width)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(s, pa.int32()), pa.array(e, pa.int32())],
                                              names=["k", "s", "e"])

        for batch in batches:
            for a, n, k, lo, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if a != anchor and size > BATCH_BYTES:
                    yield spans()
                    size = 0
                anchor = a
                held.append((n, k, lo, part))
                size += len(part) + 1
        if held:
            yield spans()

    dealt = rows.repartition("a").sortWithinPartitions("a")
    return dealt.select("a", "n", "k", "lo", "part").mapInArrow(run, "k long, s int, e int")


def repeated_spans(rows: DataFrame, width: int, gram: int, crowd: int) -> DataFrame:
    """Rows ``(k, _text)``, ``k`` naming a text, to ``(k, spans)``: stretches of
    bytes covered by strings that occur at least twice (they may overlap)."""
    found = cut(_occurrences(rows, width, gram))
    # Written first: in the join both sides are then plain shuffles, and AQE can
    # split an anchor that has a large part of all occurrences.
    stats = cut(found.groupBy("a").agg(F.count("*").alias("na"), F.min("c").alias("c0"), F.max("c").alias("c1"))
                .where("na > 1").select("a", (F.col("c0") == F.col("c1")).alias("alike")))
    shared = cut(found.join(stats, "a"))
    mixed = shared.where(~F.col("alike"))
    whole = F.struct(F.col("lo").alias("s"), (F.col("lo") + F.col("size") + width - 1).alias("e"))
    kinds = cut(mixed.groupBy("a", "c").agg(F.count("*").alias("n"), F.min(F.struct("k", "lo", "size")).alias("r")))
    crowds = kinds.groupBy("a").agg((F.count("*") > crowd).alias("crowded"))
    need = (kinds.join(crowds, "a").groupBy(F.col("r.k").alias("k"))
            .agg(F.collect_list(F.struct("a", "n", "r.lo", "r.size", "crowded")).alias("need")))
    drawn = cut(_extract(rows.join(need.hint("shuffle_hash"), "k").select("k", "_text", "need"), width))
    twice = (drawn.where("part is null").groupBy("a", "string").agg(F.sum("n").alias("m"))
             .where("m > 1").select("a", "string"))
    strings = (drawn.where("part is null and n = 1").join(twice, ["a", "string"])
               .select("k", F.col("lo").alias("s"), (F.col("lo") + width).alias("e")))
    sorted_ = _suffix_spans(drawn.where("part is not null"), width)
    copied = mixed.join(kinds.where("n > 1").select("a", "c"), ["a", "c"])
    spans = (shared.where("alike").unionByName(copied).select("k", whole.alias("span"))
             .unionByName(sorted_.unionByName(strings).select("k", F.struct("s", "e").alias("span"))))
    return spans.groupBy("k").agg(F.collect_list("span").alias("spans"))


def remove_repeats(docs: DataFrame, width: int = 200, gram: int = 32, crowd: int = 10_000,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with columns ``n_bytes``, ``n_removed``, ``n_spans``, ``kept``
    (the remaining bytes) and ``kept_text`` (the remaining whole characters: a
    character goes only if all its bytes do).

    Every byte covered by a string of ``width`` bytes that also starts anywhere
    else, in another text or the same, is removed, at all its places; strings
    never cross texts and are judged on the input.  Texts are named by a hash
    of id and text, so rows may repeat: they are copies of each other.  Null
    text counts as empty: nothing removed, ``kept_text`` null.  Texts under
    ``width`` bytes are kept.  Other columns are passed through.

    An anchor with more than ``crowd`` different contexts is split: its strings
    are counted one by one by hash, pre-aggregated, so that no task has to hold
    such a group; the result is the same."""
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    text = F.coalesce(F.col(text_col), F.lit(""))
    spans = repeated_spans(docs.select(key.alias("k"), text.alias("_text")), width, gram, crowd)
    others = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(docs.columns)]
    rows = (docs.select(key.alias("k"), F.col(text_col).alias("_text"), *others)
            .join(spans.hint("shuffle_hash"), "k", "left").drop("k"))

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, gone, runs, kept, texts = [], [], [], [], []
            at_text, at_spans = batch.schema.get_field_index("_text"), batch.schema.get_field_index("spans")
            for value, found in zip(batch.column(at_text), batch.column(at_spans), strict=True):
                raw = value.as_buffer().to_pybytes() if value.is_valid else b""
                n.append(len(raw))
                if not found.is_valid:
                    gone.append(0)
                    runs.append(0)
                    kept.append(raw)
                    texts.append(raw if value.is_valid else None)
                    continue
                s, e = (found.values.field(i).to_numpy() for i in (0, 1))
                edge = np.zeros(len(raw) + 1, np.int64)
                np.add.at(edge, s, 1)
                np.add.at(edge, e, -1)
                out = np.cumsum(edge[:-1]) > 0
                data = np.frombuffer(raw, np.uint8)
                kept.append(data[~out].tobytes())
                gone.append(int(out.sum()))
                runs.append(int((out & ~np.concatenate([[False], out[:-1]])).sum()))
                first = np.flatnonzero((data & 0xC0) != 0x80)
                some = np.logical_and.reduceat(out, first)
                texts.append(data[~np.repeat(some, np.diff(np.append(first, len(data))))].tobytes())
            rest = [batch.column(i) for i in range(batch.num_columns) if i not in (at_text, at_spans)]
            return pa.RecordBatch.from_arrays(
                [*rest, pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()),
                 pa.array(kept, pa.binary()), pa.array(texts, pa.binary()).cast(pa.string())],
                names=[*(f"_c{i}" for i in range(len(rest))), "n_bytes", "n_removed", "n_spans", "kept", "kept_text"])
        return each

    schema = StructType([*(StructField(f"_c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)),
                         *StructType.fromDDL("n_bytes long, n_removed long, n_spans long, kept binary, kept_text string")])
    new = ["n_bytes", "n_removed", "n_spans", "kept", "kept_text"]
    done = map_arrow(rows, make, schema)
    return done.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns) if c not in new), *new)
