import itertools
import math

import numpy as np
import pyarrow as pa
import pytest

from wattgrid.llm import toxicity as tx
from wattgrid.llm.queries import op4_toxicity

from .helpers import ODD, empty_frame, odd_frame, remainder

DOCS = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def result(spark):
    labels = spark.read.parquet(f"{DOCS}/labels.parquet").select("doc_id", "toxic")
    return op4_toxicity(spark, DOCS).join(labels, "doc_id", "left").collect()


def test_whole_table(result, spark):
    assert len(result) == spark.read.parquet(f"{DOCS}/documents.parquet").count()
    assert all(r["held_out"] == (remainder(r["doc_id"], 5) == 0) for r in result)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in result)


def test_held_out_accuracy(result):
    held = [r for r in result if r["held_out"] and r["toxic"] is not None]
    assert sum(r["predicted"] == r["toxic"] for r in held) / len(held) > 0.93
    assert not any(r["predicted"] for r in held if r["toxic"] == 0)


def test_spans_are_offsets_of_words(spark, result):
    texts = dict(spark.read.parquet(f"{DOCS}/documents.parquet").select("doc_id", "text").collect())
    words = {texts[r["doc_id"]][s["from"]:s["to"]].lower() for r in result for s in r["spans"]}
    assert words and all(w.strip(" .,\n!") == w for w in words)
    assert "idiot" in {x for w in words for x in w.split()}


def test_marginals_against_enumeration():
    rnd = np.random.default_rng(0)
    crf = tx.Crf(np.zeros(1), 0.0, 0.3, rnd.normal(size=(2, 2)), np.zeros(3))
    first = np.array([0, 4, 4, 5, 10])
    e = rnd.normal(size=10)
    p, expected = tx.marginals(e, first, crf)
    counted = np.zeros(4)
    for a, b in itertools.pairwise(first):
        total, got, pairs = 0.0, np.zeros(b - a), np.zeros((b - a, 4))
        for path in itertools.product((0, 1), repeat=b - a):
            s = crf.start * path[0] if path else 0.0
            s += sum(e[a + i] for i, y in enumerate(path) if y)
            s += sum(crf.step[x, y] for x, y in itertools.pairwise(path))
            weight = math.exp(s)
            total += weight
            got += weight * np.array(path)
            for i in range(1, b - a):
                pairs[i, path[i - 1] * 2 + path[i]] += weight
        assert np.allclose(p[a:b], got / total)
        counted += (pairs / total).sum(axis=0)
    assert np.allclose(expected.ravel(), counted)


def test_marginals_of_many_tokens_stay_probabilities():
    crf = tx.Crf(np.zeros(1), 0.0, 0.0, np.array([[3.0, -3.0], [-3.0, 3.0]]), np.zeros(3))
    e = np.random.default_rng(1).normal(size=200_000) * 40
    p, _ = tx.marginals(e, np.array([0, 199_000, 200_000]), crf)
    assert np.isfinite(p).all() and ((p >= 0) & (p <= 1)).all()


def test_copied_words_are_not_toxic_labels():
    toxic = [f"aa{i} slur bb{i} plain words here" for i in range(20)] + ["one long copied document with slur inside"] * 30
    clean = [f"cc{i} dd{i} plain words here" for i in range(50)]
    texts = toxic + clean
    labels = np.array([True] * 50 + [False] * 50)
    ids, owner, k = [], [], 0
    for piece in tx.pieces(pa.array(texts)):
        w, f = tx.token_features(piece)
        ids.append(f)
        owner.append(w.text + k)
        k += len(piece)
    ids, owner = np.concatenate(ids), np.concatenate(owner)
    got = tx.token_labels(ids, owner, labels, lift=10.0)
    words = [x for t in texts for x in t.split()]
    assert {w for w, y in zip(words, got, strict=True) if y} == {"slur"}


def test_odd_rows_and_empty_table(spark):
    model = tx.fit([("you idiot fool", 1), ("nice day out", 0)] * 20)
    got = tx.score(odd_frame(spark), model).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (3, 4, 5, 13)}) == 1
    assert tx.score(empty_frame(spark), model).count() == 0
    nothing = tx.fit([])
    assert {r["score"] for r in tx.score(odd_frame(spark), nothing).collect()} == {0.5}
