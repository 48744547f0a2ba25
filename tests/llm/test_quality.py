import numpy as np
import pyarrow as pa
import pytest

from wattgrid.llm import quality
from wattgrid.llm.common import training_sample
from wattgrid.llm.queries import op9_quality
from wattgrid.llm.words import pieces
from pyspark.sql import functions as F

from .helpers import ODD, empty_frame, odd_frame, remainder

DOCS = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def result(spark):
    labels = spark.read.parquet(f"{DOCS}/labels.parquet").select("doc_id", "quality")
    return op9_quality(spark, DOCS).join(labels, "doc_id", "left").collect()


def test_whole_table(result, spark):
    assert len(result) == spark.read.parquet(f"{DOCS}/documents.parquet").count()
    assert all(r["held_out"] == (remainder(r["doc_id"], 4) == 2) for r in result)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in result)


def test_held_out_accuracy(result):
    held = [r for r in result if r["held_out"] and r["quality"] is not None]
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.95


def test_score_is_the_dot_product():
    rnd = np.random.default_rng(2)
    w = rnd.normal(size=(1 << quality.BITS) + 1)
    texts = ["a b c, THE end!!", "", "word " * 50, "één 12 twee"]
    for piece in pieces(pa.array(texts)):
        ids, bounds = quality.features(piece)
        for i in range(len(piece)):
            own = ids[bounds[i]:bounds[i + 1]]
            alone, _ = quality.features(next(iter(pieces(pa.array([texts[i]])))))
            assert sorted(own) == sorted(alone)
    assert len(ids[bounds[1]:bounds[2]]) == 0
    assert len(ids[bounds[2]:bounds[3]]) == 50 + 49 + 50 + 49 + 48
    assert w[ids].shape == ids.shape


def test_learner_follows_the_published_update():
    model = quality.Ftrl(alpha=0.5, beta=1.0, l1=0.1, l2=0.2)
    at, x = np.array([3, 5]), np.array([1.0, 2.0])
    z, n = np.zeros(2), np.zeros(2)
    for y in (1.0, 0.0, 1.0, 1.0):
        w = np.where(np.abs(z) <= 0.1, 0, -(z - np.sign(z) * 0.1) / ((1 + np.sqrt(n)) / 0.5 + 0.2))
        g = (1 / (1 + np.exp(-(w @ x))) - y) * x
        z += g - (np.sqrt(n + g * g) - np.sqrt(n)) / 0.5 * w
        n += g * g
        model.update(at, x, y)
        assert np.allclose(model.z[at], z) and np.allclose(model.n[at], n)
    assert np.count_nonzero(model.weights()) == 2


def test_sample_is_bounded_and_keeps_out_held_rows(spark):
    docs = spark.createDataFrame([(i, f"text {i} " + "z" * 50) for i in range(200)] + [(None, "x"), (500, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] * 2 + [(None, 1), (7, None), (500, 1)], "doc_id long, quality int")
    got = training_sample(docs, labels, "quality", F.col("doc_id") % 4 != 2, (10, 20), max_chars=9)
    assert len(got) <= 30 and sum(y for _, y in got) >= 19 and all(len(t) <= 9 for t, _ in got)
    assert all(int(t.split()[1]) % 4 != 2 for t, _ in got)
    assert got == training_sample(docs.repartition(3), labels.repartition(2), "quality", F.col("doc_id") % 4 != 2, (10, 20), max_chars=9)


def test_odd_rows_and_empty_table(spark):
    weights = quality.fit([("fine words in a row", 1), ("!!! $$$ ###", 0)] * 10)
    got = quality.score(odd_frame(spark), weights).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (3, 4, 5, 13)}) == 1
    assert quality.score(empty_frame(spark), weights).count() == 0
    assert {r["score"] for r in quality.score(odd_frame(spark), quality.fit([])).collect()} == {0.5}
