import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from wattgrid.llm import fingerprints as fp
from wattgrid.llm.queries import op7_fingerprints
from wattgrid.llm.words import LETTERS_DIGITS, LOWER_ASCII, Words, pieces

from .helpers import DOCS, ODD, empty_frame, letters_words, odd_frame


def term(word):
    return int(Words(next(iter(pieces(pa.array([word])))), LETTERS_DIGITS, LOWER_ASCII).hash[0])


@pytest.fixture(scope="module")
def result(spark):
    return {r["doc_id"]: r for r in op7_fingerprints(spark, DOCS).collect()}


@pytest.fixture(scope="module")
def texts(spark):
    return sorted(tuple(r) for r in spark.read.parquet(f"{DOCS}/documents.parquet").select("doc_id", "text").collect())


def test_edits_and_equal_texts(result, texts):
    assert result.keys() == {d for d, _ in texts}
    prints = {}
    for i, (d, text) in enumerate(texts):
        following = texts[(i + 1) % len(texts)]
        half = len(text) // 2
        changed = text[:len(text) - half] + following[1][:half]
        r = result[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert r["near_edited"] == fp.likeness(r["fingerprint"], r["edited_fingerprint"])
        assert r["near_next"] == fp.likeness(r["fingerprint"], result[following[0]]["fingerprint"])
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert prints.setdefault(changed, r["edited_fingerprint"]) == r["edited_fingerprint"]


def test_edited_texts_are_nearer_than_the_next(result):
    near = [r["near_edited"] for r in result.values()]
    far = [r["near_next"] for r in result.values()]
    assert sum(near) / len(near) > 10 * sum(far) / len(far) and sum(near) / len(near) > 0.05


def test_lexicon_holds_the_band_exactly(spark):
    rows = [f"all common{i % 3} half{i % 2} rare{i % 40} single{i}" for i in range(400)]
    df = spark.createDataFrame([(t,) for t in rows], "text string").repartition(7)
    got = set(fp.lexicon(df, rarest=0.02, commonest=0.34).tolist())
    count = {}
    for t in rows:
        for w in set(letters_words(t)):
            count[w] = count.get(w, 0) + 1
    assert got == {term(w) for w, n in count.items() if 8 <= n <= 136}


def test_fingerprint_parts():
    words = [f"term{i}" for i in range(300)]
    lexicon = np.sort(np.array([term(w) for w in words[:250]], np.uint64))
    a, b, c = fp.fingerprints(pa.array([" ".join(words), " ".join(reversed(words)) + " term1 noise", " ".join(words[:125])]), lexicon)
    assert a == b and a != c and 0 < fp.likeness(a, c) < 1 and fp.likeness(a, b) == 1
    assert re.fullmatch(r"([0-9a-f]{8}|\.{8})+", a) and len(a) == fp.DIGITS * len(fp.PARTS)
    alone, other, none = fp.fingerprints(pa.array(["unseen words", "other unseen words", "..."]), lexicon)
    assert fp.likeness(alone, other) == 0 and set(none) == {"."}


def test_edited():
    assert [fp.edited(t, "xyz") for t in ("", "a", "ab", "abcde", "abcdefghij")] == ["", "a", "ax", "abcxy", "abcdexyz"]


def test_odd_rows_and_empty_table(spark):
    df = odd_frame(spark).repartition(5)
    got = fp.fingerprint_chain(df, fp.lexicon(df, rarest=0.1, commonest=0.9)).collect()
    assert len(got) == len(ODD)
    order = sorted(((d is not None, d or 0), t or "") for d, t in ODD)
    follows = [hashlib.sha256(fp.edited(t, order[(i + 1) % len(order)][1]).encode()).hexdigest() for i, (_, t) in enumerate(order)]
    assert sorted(r["edited_sha256"] for r in got) == sorted(follows)
    assert fp.fingerprint_chain(empty_frame(spark), fp.lexicon(empty_frame(spark))).count() == 0
    one = fp.fingerprint_chain(df.where("doc_id = 11"), np.zeros(0, np.uint64)).first()
    assert (one["n_chars"], one["near_edited"], one["near_next"]) == (1000, 1.0, 1.0)
