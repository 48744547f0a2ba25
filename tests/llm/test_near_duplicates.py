import random

import numpy as np
import pytest

from wattgrid.llm import near_duplicates as nd
from wattgrid.llm.graph import components
from wattgrid.llm.queries import op3_near_duplicates

from .helpers import DOCS, empty_frame, near_components, odd_frame, shingle_set


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DOCS}/documents.parquet").select("doc_id", "text").collect()]
    want = near_components(rows, 85)
    got = {r["doc_id"]: r for r in op3_near_duplicates(spark, DOCS).collect()}
    assert {d: r["component_id"] for d, r in got.items()} == want
    assert all(got[d]["n_shingles"] == len(shingle_set(t)) for d, t in rows)
    assert all(r["kept"] == (d == r["component_id"]) for d, r in got.items())


@pytest.mark.parametrize("similarity", [0.8, 0.85])
def test_chains_and_near_misses(spark, similarity):
    """Mutated copies around the threshold, chains that link only in steps."""
    rnd = random.Random(3)
    rows, n = [], 0
    for _ in range(6):
        words = [f"w{rnd.randrange(400)}" for _ in range(rnd.choice([20, 60, 150]))]
        for _ in range(25):
            rows.append((n, rnd.choice([" ", "\n"]).join(words)))
            n += 1
            words = list(words)
            for _ in range(rnd.choice([0, 1, 1, 2])):
                words[rnd.randrange(len(words))] = f"m{rnd.randrange(9999)}"
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), similarity).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == near_components(rows, round(100 * similarity))


def test_sketch_estimates_similarity_and_fills():
    rnd = np.random.default_rng(1)
    base = rnd.integers(0, 2**63, 400).astype(np.uint64)
    other = base.copy()
    other[:100] = rnd.integers(0, 2**63, 100).astype(np.uint64)   # similarity 300 / 500
    a, b, one = np.sort(base), np.sort(other), base[:1]
    values = np.concatenate([a, b, one])
    s = nd.sketch(values, np.array([0, 400, 800, 801, 801]), 128)
    assert (s[:3] != np.iinfo(np.uint64).max).all()
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.15
    assert (s[3] == 0).all()


def test_banding_misses_less_than_one_in_a_million():
    for similarity in (0.8, 0.85, 0.9):
        bands, rows = nd.banding(similarity)
        assert bands * rows <= 128 and (1 - similarity ** rows) ** bands < 1e-6


def test_odd_rows_and_empty_table(spark):
    got = nd.near_duplicates(odd_frame(spark)).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 16
    assert by[1]["component_id"] == by[2]["component_id"] == 1 and by[1]["kept"] and not by[2]["kept"]
    null = [r for r in got if r["doc_id"] is None]
    assert sorted((r["n_shingles"] > 0, r["component_id"], r["kept"]) for r in null) == [(False, None, True), (True, 1, False)]
    for d in (3, 4, 5, 13):
        assert (by[d]["n_shingles"], by[d]["component_id"], by[d]["kept"]) == (0, d, True)
    assert by[8]["n_shingles"] == 1 and by[11]["component_id"] == by[12]["component_id"] == 11
    assert nd.near_duplicates(empty_frame(spark)).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(50)}


def test_blocks_of_a_large_loose_family(spark):
    """Copies whose similarities lie around the threshold, in blocks smaller
    than the family."""
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rnd.randrange(0, 6)):
            words[rnd.randrange(80)] = f"m{rnd.randrange(30)}"
        rows.append((i, " ".join(words)))
    got = nd.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 0.8, block=20).collect()
    want = near_components(rows, 80)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert 1 < len(set(want.values())) < 100
