"""I-Match fingerprints: hashes of the terms within a band of document
frequencies, over several randomised parts of that lexicon."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, map_arrow, with_id
from .words import LETTERS_DIGITS, LOWER_ASCII, Words, mix, pieces

_U = np.uint64
#: Parts of the lexicon: how many leading zero bits a term's hash for the part
#: must have.  A part tells two texts alike if none of its terms in either was
#: changed, so long or much edited texts need small parts; a part that neither
#: text has terms in tells nothing.
PARTS = (0, 3, 3, 4, 4, 5, 5, 5, 6, 6, 6, 6, 7, 7, 7, 7, 7, 8, 8, 8, 8, 8, 8, 9, 9, 9, 9, 9, 10, 10, 10, 10)
DIGITS = 8
NONE = "." * DIGITS
_ORDER = _U(0xA0761D6478BD642F)


def _terms(piece) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms of each text, sorted by (text, term), and their texts."""
    w = Words(piece, LETTERS_DIGITS, LOWER_ASCII)
    text = w.text
    order = np.lexsort((w.hash, text))
    h, t = w.hash[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    return h[new], t[new]


class Tally:
    """Counts of 64-bit terms, merged whenever the waiting ones outgrow them."""

    def __init__(self):
        self.keys, self.counts, self.waiting, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def add(self, terms: np.ndarray) -> None:
        self.waiting.append(terms)
        self.size += len(terms)
        if self.size > max(1 << 20, len(self.keys)):
            self.merge()

    def merge(self) -> None:
        if self.waiting:
            new, n = np.unique(np.concatenate(self.waiting), return_counts=True)
            both = np.concatenate([self.keys, new])
            self.keys, at = np.unique(both, return_inverse=True)
            self.counts = np.bincount(at, weights=np.concatenate([self.counts, n])).astype(np.int64)
            self.waiting, self.size = [], 0


def lexicon(docs: DataFrame, rarest: float = 0.001, commonest: float = 0.2, text_col: str = "text") -> np.ndarray:
    """Sorted hashes of the terms that at least a ``rarest`` and at most a
    ``commonest`` share of all documents have, and at least two.

    Two passes over all texts.  A term with that share of all documents has it
    in at least one partition, so the first pass only reports such terms, the
    second counts those exactly.  Their number is at most the mean number of
    distinct terms in a text divided by ``rarest``, whatever the number of
    documents; that bounds what the driver holds and broadcasts."""
    texts = docs.select(F.col(text_col).alias("_text"))

    def frequent(batches):
        tally, n = Tally(), 0
        for batch in batches:
            n += batch.num_rows
            for piece in pieces(batch.column(0)):
                tally.add(_terms(piece)[0])
        tally.merge()
        keep = tally.keys[tally.counts >= rarest * n]
        yield pa.RecordBatch.from_arrays([pa.array(keep.view(np.int64)), pa.array(np.zeros(len(keep), np.int64))],
                                         names=["term", "n"])
        # The number of documents, under a term of its own kind.
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([n], pa.int64())], names=["term", "n"])

    got = texts.mapInArrow(frequent, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    terms, counts = got.column("term").combine_chunks(), got.column("n").to_numpy()
    null = terms.is_null().to_numpy(zero_copy_only=False)
    total = int(counts[null].sum())
    candidates = np.sort(terms.drop_null().to_numpy().view(np.uint64))
    if len(candidates) == 0:
        return candidates
    shared = docs.sparkSession.sparkContext.broadcast(candidates)

    def exact(batches):
        known = shared.value
        counts = np.zeros(len(known), np.int64)
        for batch in batches:
            for piece in pieces(batch.column(0)):
                h, _ = _terms(piece)
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                counts += np.bincount(at[known[at] == h], minlength=len(known))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(known[some].view(np.int64)), pa.array(counts[some])], names=["term", "n"])

    band = (texts.mapInArrow(exact, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
            .where((F.col("n") >= max(2.0, rarest * total)) & (F.col("n") <= commonest * total)).toArrow())
    return np.sort(band.column("term").combine_chunks().to_numpy().view(np.uint64))


def _hash_runs(terms: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Hash of each owner's terms in their order; 0 where there are none."""
    out = np.zeros(n, np.uint64)
    if len(terms):
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        rank = np.arange(len(terms)) - np.repeat(first, np.diff(np.append(first, len(terms))))
        powers = np.full(int(rank.max()) + 1, _ORDER)
        powers[0] = 1
        out[owner[first]] = mix(np.add.reduceat(mix(terms) * np.multiply.accumulate(powers)[rank], first)) | _U(1)
    return out


def fingerprints(texts: pa.Array, lexicon: np.ndarray) -> list[str]:
    """For each text the hashes of its sorted distinct terms in each part of
    the lexicon, as one string; a part without terms is a row of dots.  A text
    without any term of the lexicon is hashed over all its terms in the first
    part; a text without words is dots throughout."""
    out: list[str] = []
    for piece in pieces(texts):
        h, t = _terms(piece)
        n = len(piece)
        at = np.minimum(np.searchsorted(lexicon, h), max(0, len(lexicon) - 1))
        inside = lexicon[at] == h if len(lexicon) else np.zeros(len(h), bool)
        has = np.zeros(n, bool)
        has[t[inside]] = True
        columns = []
        for k, zeros in enumerate(PARTS):
            use = inside & (mix(h + _U(k + 1)) >> _U(64 - zeros) == 0) if zeros else inside
            if k == 0:
                use = use | ~has[t]
            columns.append(_hash_runs(h[use], t[use], n) >> _U(32))
        for row in np.stack(columns, axis=1).tolist():
            out.append("".join(f"{v:0{DIGITS}x}" if v else NONE for v in row))
    return out


def likeness(a: str, b: str) -> float:
    """Share of equal parts among those that either has terms in; 1 for two
    fingerprints without any."""
    parts = [(a[i:i + DIGITS], b[i:i + DIGITS]) for i in range(0, len(a), DIGITS)]
    used = [x == y for x, y in parts if x != NONE or y != NONE]
    return sum(used) / len(used) if used else 1.0


def edited(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by the first as
    many of the text that follows (or all it has)."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_OUT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(ids: list, texts: list[str], prints: list[str], followers: list[str], follower_prints: list[str],
             words: np.ndarray) -> list[list]:
    changed = [edited(a, b) for a, b in zip(texts, followers, strict=True)]
    changed_prints = fingerprints(pa.array(changed, pa.string()), words)
    return [ids, [len(t) for t in texts], [hashlib.sha256(c.encode()).hexdigest() for c in changed], prints,
            changed_prints, [likeness(a, b) for a, b in zip(prints, changed_prints, strict=True)],
            [likeness(a, b) for a, b in zip(prints, follower_prints, strict=True)]]


def fingerprint_chain(docs: DataFrame, words: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row its fingerprint, that of its edited text (see ``edited``)
    and their likeness to it and to the next row's; the next row is the one
    with the next greater id (equal ids: by text), after the last the first.

    Rows are dealt out by ranges of the id and sorted, so each task meets
    neighbours in turn; only the first and last row of each range, two per
    partition, are paired in a second step.  Null texts count as empty; null
    ids come first.  A single row follows itself.  An empty table gives an
    empty result.  No other column is read."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(words)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, "id").sortWithinPartitions("id", "text")
    names = ["id", *(c.split()[0] for c in _OUT.split(", ")), "place", "part", "text"]

    def walk(batches):
        lexicon_, part = shared.value, TaskContext.get().partitionId()
        held = None  # the last row so far: id, text, fingerprint
        schema = None

        def edge(place, row):
            return pa.RecordBatch.from_arrays(
                [pa.array([row[0]], schema), *[pa.nulls(1, t) for t in (pa.int64(), pa.string())],
                 pa.array([row[2]], pa.string()), pa.nulls(1, pa.string()), *[pa.nulls(1, pa.float64())] * 2,
                 pa.array([place], pa.string()), pa.array([part], pa.int32()), pa.array([row[1]], pa.string())], names=names)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            schema = batch.column(0).type
            texts, prints = batch.column(1).to_pylist(), fingerprints(batch.column(1), lexicon_)
            here = list(zip(batch.column(0).to_pylist(), texts, prints, strict=True))
            if held is None:
                yield edge("first", here[0])
            else:
                here.insert(0, held)
            held = here[-1]
            if len(here) > 1:
                ids, texts, prints = map(list, zip(*here, strict=True))
                got = _compare(ids[:-1], texts[:-1], prints[:-1], texts[1:], prints[1:], lexicon_)
                m = len(here) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got[0], schema), pa.array(got[1], pa.int64()), *[pa.array(c, pa.string()) for c in got[2:5]],
                     *[pa.array(c, pa.float64()) for c in got[5:]], pa.nulls(m, pa.string()), pa.nulls(m, pa.int32()),
                     pa.nulls(m, pa.string())], names=names)
        if held is not None:
            yield edge("last", held)

    done = cut(dealt.mapInArrow(walk, with_id(rows, "id", f"{_OUT}, place string, part int, text string")))
    # Two rows per partition at most.
    turn = Window.orderBy("part")
    all_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = done.where("place = 'first'").select("part", F.struct("text", "fingerprint").alias("f"))
    firsts = firsts.select("part", F.coalesce(F.lead("f").over(turn), F.first("f").over(all_parts)).alias("f"))
    ends = (done.where("place = 'last'").select("id", "part", "text", "fingerprint").join(firsts, "part")
            .select("id", "text", "fingerprint", F.col("f.text").alias("next"), F.col("f.fingerprint").alias("next_print")))

    def make():
        lexicon_ = shared.value

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            got = _compare(*(c.to_pylist() for c in batch.columns), lexicon_)
            return pa.RecordBatch.from_arrays(
                [pa.array(got[0], batch.column(0).type), pa.array(got[1], pa.int64()),
                 *[pa.array(c, pa.string()) for c in got[2:5]], *[pa.array(c, pa.float64()) for c in got[5:]]],
                names=names[:-3])
        return each

    paired = map_arrow(ends, make, with_id(rows, "id", _OUT))
    return (done.where("place is null").select(*names[:-3]).unionByName(paired)
            .withColumnRenamed("id", id_col))
