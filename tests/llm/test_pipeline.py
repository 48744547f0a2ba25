import os
import re

import pytest

import corpus_pipeline
from wattgrid.llm import language

from .helpers import DOCS, contaminated, covered, empty_frame, near_components

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{DOCS}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, docs, DOCS))
        out.append(docs.collect())
    return out


def rows(table):
    return sorted((r["doc_id"], r["text"]) for r in table)


def test_stages_against_brute_force(spark, steps):
    docs, named, single, cleaned, clean, encoded = steps
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "suffix_dedup", "decontamination", "sentencepiece"]
    dictionaries = language.fit_dictionaries(spark.createDataFrame(docs, COLUMNS))
    found = language.identify(spark.createDataFrame(docs, COLUMNS), dictionaries).collect()
    assert {r["doc_id"] for r in named} == {r["doc_id"] for r in found if not r["rejected"]}
    assert len(named) > 0.9 * len(docs)
    component = near_components(rows(named), 80)
    assert rows(single) == [(d, t) for d, t in rows(named) if component[d] == d]
    texts = rows(single)
    masks = covered([t.encode() for _, t in texts], 200)
    want = []
    for (d, t), m in zip(texts, masks, strict=True):
        at, kept = 0, ""
        for c in t:
            size = len(c.encode())
            kept += "" if all(m[at:at + size]) else c
            at += size
        want.append((d, kept))
    assert rows(cleaned) == want
    assert all(r["n_chars"] == len(r["text"]) for r in cleaned)
    items = [tuple(r) for r in spark.read.parquet(f"{DOCS}/benchmark.parquet").select("item_id", "text").collect()]
    hits = contaminated(rows(cleaned), items)
    assert rows(clean) == [(d, t) for d, t in rows(cleaned) if not hits[d][1]]
    assert {r["doc_id"] for r in encoded} == {r["doc_id"] for r in clean} and all(r["round_trip"] for r in encoded)


def test_run_gives_the_last_stage(spark, steps):
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, DOCS).collect()) == sorted(r["doc_id"] for r in steps[-1])
    assert corpus_pipeline.ORACLE_SQL is None


def test_odd_and_empty_tables(spark):
    odd = [(1, "one text of several words here to keep", "en", "s", 39), (1, "one text of several words here to keep", "en", "s", 39),
           (None, "another text of quite other words to keep", None, None, None), (2, None, "en", "s", None), (3, "", None, "s", 0),
           (4, "mots français dans un texte à garder", "fr", None, 36), (5, "z" * 900, "fr", "s", 900), (6, "z" * 901, "en", "s", 901)]
    extra = spark.createDataFrame([(*r, "x", 1.0) for r in odd], COLUMNS + ", k string, score double")
    for docs in (extra, empty_frame(spark).select("doc_id", "text", "lang", "source", "n_chars")):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, DOCS)
            if name != "sentencepiece":
                assert got.columns == docs.columns
            assert got.count() <= docs.count()
    once = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, extra, DOCS).collect()
    assert sorted((r["doc_id"] or 0) for r in once) == [0, 1, 2, 3, 4, 5, 6]


def test_sources_do_not_swallow_import_errors():
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    files = [os.path.join(root, "corpus_pipeline.py")]
    files += [os.path.join(d, f) for d, _, names in os.walk(os.path.join(root, "wattgrid", "llm")) for f in names if f.endswith(".py")]
    for path in files:
        with open(path, encoding="utf-8") as f:
            assert not re.search(r"except\s+\(?(ImportError|ModuleNotFoundError|Exception)", f.read()), path
