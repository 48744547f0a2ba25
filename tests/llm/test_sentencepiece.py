import random

import numpy as np
import pytest

from wattgrid.llm import sentencepiece as sp
from wattgrid.llm.common import public_file
from wattgrid.llm.queries import op8_sentencepiece

from .helpers import DOCS, ODD, empty_frame, odd_frame

pytest.importorskip("sentencepiece")
PIECES = sp.Pieces.load(public_file("piece_bpe_32k.model"))
SEGMENTER = sp.Segmenter(PIECES)


def best_score(text, table, miss):
    """Plain dynamic programme over all pieces."""
    score = [0.0] + [float("-inf")] * len(text)
    longest = max(map(len, table))
    for end in range(1, len(text) + 1):
        score[end] = score[end - 1] + miss
        for start in range(max(0, end - longest), end):
            if text[start:end] in table:
                score[end] = max(score[end], score[start] + table[text[start:end]])
    return score[-1]


def score_of(ids, table_by_id, miss):
    total, run = 0.0, b""
    for i in ids:
        if i in table_by_id:
            total += table_by_id[i]
        else:
            run += PIECES.surface[i]
    return total + miss * len(run.decode())


def test_query_round_trip(spark):
    got = op8_sentencepiece(spark, DOCS).collect()
    assert len(got) == spark.read.parquet(f"{DOCS}/documents.parquet").count()
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in got)
    texts = {r["doc_id"]: r["text"] for r in sp.decode(op8_sentencepiece(spark, DOCS), PIECES).collect()}
    assert texts == dict(spark.read.parquet(f"{DOCS}/documents.parquet").select("doc_id", "text").collect())


@pytest.mark.parametrize("text", ["Hello  world", "  lead and trail  ", "a\n\nb\t c\r", "▁ meta ▁", "größe 日本 \U0001F600", " ", "\n",
                                  "the quick brown fox", "x" * 70 + " aaaa", "no pieces அஆ"])
def test_best_total_score(text):
    table = {t: s for t, _, s in PIECES.table}
    by_id = {i: s for _, i, s in PIECES.table}
    ids = SEGMENTER.encode(text)
    assert SEGMENTER.decode(ids) == text
    assert score_of(ids.tolist(), by_id, SEGMENTER.miss) == best_score(" " + text, table, SEGMENTER.miss)


def test_small_models_against_the_plain_programme():
    rnd = random.Random(4)
    for _ in range(200):
        table = {"".join(rnd.choice("ab ") for _ in range(rnd.randrange(1, 5))): -float(rnd.randrange(1, 9)) for _ in range(12)}
        pieces = sp.Pieces([(t, 300 + i, s) for i, (t, s) in enumerate(table.items())], list(range(256)),
                           [bytes([b]) for b in range(256)] + [b""] * 44 + [t.encode() for t in table], False)
        segmenter = sp.Segmenter(pieces)
        text = "".join(rnd.choice("abc ") for _ in range(rnd.randrange(1, 30)))
        ids = segmenter.encode(text)
        assert segmenter.decode(ids) == text
        total = sum(table[pieces.surface[i].decode()] if i >= 300 else segmenter.miss for i in ids.tolist())
        assert total == best_score(text, table, segmenter.miss)


def test_odd_rows_and_empty_table(spark):
    got = sp.encode(odd_frame(spark), PIECES).collect()
    assert len(got) == len(ODD)
    for r in got:
        assert r["round_trip"] is (None if r["ids"] is None else True)
    assert sorted(r["n_tokens"] for r in got if r["ids"] is None) == [0, 0, 0]
    assert [r["ids"] for r in got if r["doc_id"] == 4] == [[]]
    assert sp.encode(empty_frame(spark), PIECES).count() == 0
    assert SEGMENTER.decode(np.zeros(0, np.int32)) == ""
