"""Near-duplicates by fast similarity sketching, banding and exact checks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, map_arrow, with_id
from .graph import components
from .words import BETWEEN_BLANKS, LOWER_ASCII, Words, join_hashes, list_array, mix, pieces

_U = np.uint64
MISS = 1e-6


def banding(similarity: float, coordinates: int = 128) -> tuple[int, int]:
    """Bands and rows per band: the most rows with which a pair of that
    similarity shares no band with a probability under ``MISS``."""
    for rows in range(16, 1, -1):
        bands = coordinates // rows
        if (1 - similarity ** rows) ** bands < MISS:
            return bands, rows
    return coordinates, 1


def shingles(column: pa.Array, k: int):
    """Per piece of the column: first row, sorted distinct shingle hashes of
    all texts, their bounds, and a hash of each text's whole word sequence.  A
    text of fewer than ``k`` words has its whole sequence as its one shingle; a
    text without words has none."""
    for piece in pieces(column):
        w = Words(piece, BETWEEN_BLANKS, LOWER_ASCII)
        n, counts = len(piece), w.counts
        rank = np.arange(len(w)) - np.repeat(w.first[:-1], counts)
        up = np.full(int(rank.max()) + 1 if len(w) else 1, _U(0x8CB92BA72F3D8DD7))
        up[0] = 1
        up = np.multiply.accumulate(up)
        sums = np.concatenate([[_U(0)], np.cumsum((w.hash + _U(1)) * up[rank])]).astype(np.uint64)
        whole = mix(sums[w.first[1:]] - sums[w.first[:-1]] + counts.astype(np.uint64))
        text = w.text
        runs = join_hashes(w.hash, k)
        inside = text[:len(runs)] == text[k - 1:len(w)] if len(runs) else np.zeros(0, bool)
        short = np.flatnonzero((counts > 0) & (counts < k))
        owner = np.concatenate([text[:len(runs)][inside], short])
        value = np.concatenate([runs[inside], mix(whole[short] + _U(1))])
        order = np.lexsort((value, owner))
        owner, value = owner[order], value[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        owner, value = owner[new], value[new]
        yield piece.first, value, np.searchsorted(owner, np.arange(n + 1)), whole


def sketch(values: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """Sketches (one row of ``size`` coordinates per set) of sets of hashes.

    In round ``i`` every element is thrown into a bin by a hash of its own for
    that round; a bin keeps the least ``(round, hash)``, so elements of a later
    round only count where no earlier round has filled the bin, and sets whose
    bins are all full take part no more.  After ``size`` rounds, round ``size +
    j`` throws all elements into bin ``j``, so every bin gets filled.  Two
    sets' sketches agree in a coordinate with the probability of their
    similarity, with the concentration of an independent sample.  Empty sets
    have zeros."""
    n = len(bounds) - 1
    count = np.diff(bounds)
    out = np.full((n, size), np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(n), count)
    for i in range(2 * size):
        if len(values) == 0:
            break
        thrown = mix(values + _U(2 * i + 1))
        bins = (thrown >> _U(32)) % _U(size) if i < size else np.full(len(values), i - size, np.uint64)
        # Round above hash: filled bins are never improved by a later round.
        value = (_U(i) << _U(52)) | (mix(thrown) >> _U(12))
        np.minimum.at(out.reshape(-1), owner * size + bins.astype(np.int64), value)
        done = (out != np.iinfo(np.uint64).max).all(axis=1)
        left = ~done[owner]
        values, owner = values[left], owner[left]
    out[count == 0] = 0
    return out


def _sketch_rows(rows: DataFrame, k: int, bands: int, per_band: int) -> DataFrame:
    size = bands * per_band

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, nodes, keys = [], [], []
            for _, values, bounds, whole in shingles(batch.column(2), k):
                s = sketch(values, bounds, size).reshape(len(bounds) - 1, bands, per_band)
                key = np.zeros(s.shape[:2], np.uint64)
                for j in range(per_band):
                    key = mix(key * _U(0xD1342543DE82EF95) + s[:, :, j])
                keys.append(mix(key + np.arange(bands, dtype=np.uint64)))
                sizes.append(np.diff(bounds))
                nodes.append(whole)
            sizes, keys = np.concatenate(sizes), np.concatenate(keys)
            bounds = np.arange(len(sizes) + 1) * bands
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(np.concatenate(nodes).view(np.int64)),
                 list_array(keys.reshape(-1).view(np.int64), bounds, pa.int64())],
                names=["id", "k", "n", "node", "bands"])
        return each

    return map_arrow(rows, make, with_id(rows, "id", "k long, n long, node long, bands array<long>"))


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Those ``(u, v)`` whose full shingle sets have an intersection of at least
    ``percent`` hundredths of their union."""
    joined = (pairs.join(texts.select(F.col("node").alias("u"), F.col("text").alias("a")), "u")
              .join(texts.select(F.col("node").alias("v"), F.col("text").alias("b")), "v").select("u", "v", "a", "b"))

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            n = batch.num_rows
            owners, values, sizes = [], [], np.zeros(n, np.int64)
            for column in (2, 3):
                for first, value, bounds, _ in shingles(batch.column(column), k):
                    c = np.diff(bounds)
                    sizes[first:first + len(c)] += c
                    owners.append(first + np.repeat(np.arange(len(c)), c))
                    values.append(value)
            owner, value = np.concatenate(owners), np.concatenate(values)
            order = np.lexsort((value, owner))
            owner, value = owner[order], value[order]
            twice = (owner[1:] == owner[:-1]) & (value[1:] == value[:-1])
            common = np.bincount(owner[1:][twice], minlength=n)
            link = pa.array((100 * common >= percent * (sizes - common)) & (common > 0))
            return batch.select(["u", "v"]).filter(link)
        return each

    return map_arrow(joined, make, "u long, v long")


def _links_within(nodes: np.ndarray, component: np.ndarray, owner: np.ndarray, value: np.ndarray, sizes: np.ndarray,
                  percent: int) -> list[tuple[int, int]]:
    """Links that join rows of different components into the classes they form:
    at most one per row.  ``owner``, ``value``: shingle sets of the rows."""
    n = len(nodes)
    common = np.zeros((n, n), np.float32)
    order = np.argsort(value, kind="stable")
    owner, value = owner[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(value)))
    shared = np.flatnonzero(count > 1)
    for at in range(0, len(shared), 4096):        # columns of shingles that several rows have
        some = shared[at:at + 4096]
        rows = np.concatenate([np.arange(f, f + c) for f, c in zip(first[some], count[some], strict=True)])
        matrix = np.zeros((n, len(some)), np.float32)
        matrix[owner[rows], np.repeat(np.arange(len(some)), count[some])] = 1
        common += matrix @ matrix.T
    both = sizes[:, None] + sizes[None, :] - common
    link = ((100 * common >= percent * both) & (common > 0)) | (component[:, None] == component[None, :])
    label = np.arange(n)
    while True:
        new = np.where(link, label, n).min(axis=1)
        if (new == label).all():
            break
        label = new
    # A representative per component and class is enough.
    out = {(int(component[i]), int(label[i])): int(nodes[i]) for i in range(n) if component[i] != component[label[i]]}
    return [(node, int(nodes[k])) for (_, k), node in out.items()]


def _links_in_groups(rows: DataFrame, k: int, percent: int) -> DataFrame:
    """Rows ``(hub, i, j, node, component, text)``: links between rows of equal
    ``(hub, i, j)``, which are a bounded block and come together."""
    def run(batches):
        held: dict[str, list] = {"node": [], "component": [], "text": []}
        key = None

        def links():
            owners, values, sizes = [], [], np.zeros(len(held["node"]), np.int64)
            for first, value, bounds, _ in shingles(pa.array(held["text"], pa.string()), k):
                c = np.diff(bounds)
                sizes[first:first + len(c)] = c
                owners.append(first + np.repeat(np.arange(len(c)), c))
                values.append(value)
            got = _links_within(np.array(held["node"]), np.array(held["component"]), np.concatenate(owners),
                                np.concatenate(values), sizes, percent)
            for column in held.values():
                column.clear()
            u, v = zip(*got, strict=True) if got else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        for batch in batches:
            for hub, i, j, node, component, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (hub, i, j) != key and held["node"]:
                    yield links()
                key = (hub, i, j)
                held["node"].append(node)
                held["component"].append(component)
                held["text"].append(text)
        if held["node"]:
            yield links()

    dealt = rows.repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j")
    return dealt.select("hub", "i", "j", "node", "component", "text").mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, similarity: float = 0.8, k: int = 5, id_col: str = "doc_id",
                    text_col: str = "text", block: int = 400) -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)`` for every row.

    Words: A-Z lower-cased, between blanks.  Two texts are linked if their sets
    of ``k``-word shingles have a Jaccard similarity of ``similarity`` (in whole
    hundredths) or more; ``component_id`` is the least id that links reach;
    ``kept``: the row's own id is that one.

    Texts of equal word sequences are one node from the start.  Nodes that
    share a band meet in buckets.  First every node is checked, on full sets,
    with the least node it shares a bucket with; that settles groups of copies.
    What is left are buckets that still hold several components.  Each of them
    goes to its hub (its node with the most partners); the nodes of a hub's
    buckets are dealt out in blocks of about ``block``, and each pair of blocks
    is one small task that checks all its pairs of different components and
    returns one link per class it finds.  So no pair that shares a band is left
    unchecked unless its ends are already connected, no task holds more than
    two blocks, and pairs are never rows of a table.

    Null, empty and wordless texts: no shingles, linked with nothing.  A null
    id: component_id is the least other id of the group, or null; it is kept
    only if that is null.  Rows may repeat.  No other column is read."""
    bands, per_band = banding(similarity)
    percent = round(similarity * 100)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("k"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sketches = cut(_sketch_rows(rows, k, bands, per_band))
    nodes = cut(sketches.where("n > 0").groupBy("node").agg(F.min("id").alias("least"), F.min(F.struct("id", "k")).alias("row"),
                                                            F.first("n").alias("n"), F.first("bands").alias("bands")))
    members = nodes.select("node", "n", F.explode("bands").alias("key"))
    buckets = members.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("pivot")).where("size > 1")
    members = cut(members.join(buckets, "key"))
    first = members.where("node > pivot").groupBy(F.col("node").alias("u")).agg(F.min("pivot").alias("v"))
    # One row for each node that has a partner (equal rows may repeat).
    chosen = (nodes.join(members.select("node").distinct(), "node", "left_semi")
              .select("node", F.col("row.id").alias("_id"), F.col("row.k").alias("_k")))
    texts = cut(rows.join(chosen.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("_id")) & F.col("k").eqNullSafe(F.col("_k")))
                .select("node", "text"))
    found = cut(components(_verified(first, texts, k, percent)))

    placed = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    open_ = cut(placed.join(several.where("lo < hi").select("key"), "key"))
    partners = open_.groupBy("node").agg(F.sum("size").alias("partners"))
    hubs = open_.join(partners, "node").groupBy("key").agg(F.max(F.struct("partners", "node"))["node"].alias("hub"))
    groups = cut(open_.join(hubs, "key").select("hub", "node", "component").distinct())
    blocks = groups.groupBy("hub").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pairs = (groups.join(blocks, "hub").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("hub", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "component"))
    more = cut(_links_in_groups(pairs.join(texts, "node"), k, percent))
    if not more.isEmpty():
        found = cut(components(found.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more)))
    groups = nodes.select("node", "least").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    groups = cut(groups)
    least = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    named = groups.join(least, "component").select("node", "component_id")
    result = sketches.select("id", "n", F.when(F.col("n") > 0, F.col("node")).alias("node")).join(named, "node", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return result.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"),
                         F.col("id").eqNullSafe(own).alias("kept"))
