import random

import numpy as np
import pytest

from wattgrid.llm import repeats, suffixes
from wattgrid.llm.queries import op10_suffix_dedup
from pyspark.sql import functions as F

from .helpers import DOCS, covered, empty_frame, odd_frame


def runs(mask):
    return len([r for r in mask.split(b"\0") if r])


def check(got, rows, width):
    masks = covered([(t or "").encode() for _, t in rows], width)
    want = []
    for (d, t), m in zip(rows, masks, strict=True):
        raw = (t or "").encode()
        want.append((d is not None, d or 0, len(raw), sum(m), runs(m), bytes(b for b, x in zip(raw, m, strict=True) if not x)))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
                  for r in got) == sorted(want)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DOCS}/documents.parquet").select("doc_id", "text").collect()]
    masks = covered([t.encode() for _, t in rows], 200)
    kept = spark.createDataFrame([(d, bytes(b for b, x in zip(t.encode(), m, strict=True) if not x), len(t.encode()), sum(m), runs(m))
                                  for (d, t), m in zip(rows, masks, strict=True)], "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")
    want = {tuple(r) for r in kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()}
    assert {tuple(r) for r in op10_suffix_dedup(spark, DOCS).collect()} == want


@pytest.mark.parametrize("crowd", [1000, 2])
def test_shared_passages(spark, crowd):
    """Passages with other text around, cut, mutated, overlapping, repeated in
    one text; with ``crowd`` 2 nearly all groups go the split way."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 9)))
    passage = [" ".join(word() for _ in range(30)) for _ in range(4)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rnd.randrange(1, 4)):
            p = rnd.choice(passage)
            a = rnd.randrange(0, 40)
            p = p[a:a + rnd.randrange(30, 150)]
            if rnd.random() < 0.5:
                p = p[:50] + "Z" + p[51:]
            parts += [" ".join(word() for _ in range(rnd.randrange(0, 20))), p]
        rows.append((i, " ".join(parts)))
    rows += [(100, "ab" * 60), (101, "c" * 75), (102, "né" * 40 + passage[0]), (103, "é" * 39)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(repeats.remove_repeats(df, width=40, gram=8, crowd=crowd).collect(), rows, 40)


def test_whole_characters_stay(spark):
    df = spark.createDataFrame([(1, "é" * 21 + "x"), (2, "y" + "é" * 21)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in repeats.remove_repeats(df, width=41, gram=8).collect()}
    for r in got.values():
        assert r["kept_text"] in ("x", "y", "xé", "éx", "yé", "éy") and len(r["kept"]) >= 1


def test_odd_rows_and_empty_table(spark):
    df = odd_frame(spark).withColumn("kept", F.lit(1))
    got = repeats.remove_repeats(df, width=30, gram=8).collect()
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    check(got, rows, 30)
    assert all(r["kept_text"] is None for r in got if r["text"] is None)
    assert all(r["kept_text"] == r["kept"].decode() for r in got if r["text"] is not None)
    assert {"lang", "source", "score", "k", "id", "n"} <= set(got[0].asDict())
    assert repeats.remove_repeats(empty_frame(spark)).count() == 0


def test_two_stage_sort():
    rnd = random.Random(6)
    for alphabet in (b"a", b"ab", b"abcd \xc3\xa9"):
        for n in (0, 1, 2, 3, 10, 200):
            for _ in range(20):
                text = bytes(rnd.choice(alphabet) for _ in range(n))
                order = suffixes.two_stage_sort(np.frombuffer(text, np.uint8), n + 1)
                assert order.tolist() == sorted(range(n), key=lambda i: text[i:])
                up = suffixes.smaller_than_next(np.frombuffer(text, np.uint8))
                assert up.tolist() == [text[i:] < text[i + 1:] for i in range(n)]
                if n > 1:
                    common = suffixes.common_prefixes(np.frombuffer(text, np.uint8), order, 24)
                    for a, b, c in zip(order, order[1:], common, strict=False):
                        x, y, m = text[a:], text[b:], 0
                        while m < min(len(x), len(y)) and x[m] == y[m]:
                            m += 1
                        assert min(m, 24) == min(c, 24)


def test_repeated_starts():
    rnd = random.Random(7)
    contexts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(0, 40))) for _ in range(50)]
    count = {}
    for c in contexts:
        for i in range(len(c) - 7):
            count[c[i:i + 8]] = count.get(c[i:i + 8], 0) + 1
    for c, hit in zip(contexts, suffixes.repeated_starts(contexts, 8), strict=True):
        assert hit.tolist() == [i + 8 <= len(c) and count[c[i:i + 8]] > 1 for i in range(len(c))]
