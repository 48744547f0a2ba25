import hashlib
from collections import Counter
from itertools import accumulate

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wattgrid.llm import alignment
from wattgrid.llm.common import public_file
from wattgrid.llm.queries import op13_token_alignment

from .helpers import DOCS, ODD, empty_frame, odd_frame

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
A = tokenizers.Tokenizer.from_file(public_file("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_file("piece_bpe_32k.model"))
BOTH = alignment.Tokenizers.load(public_file("byte_bpe_50k.json"), public_file("piece_bpe_32k.model"))
ALIGNER = alignment.Aligner(BOTH)
LETTERS = {c: bytes([b]) for c, b in alignment.byte_letters().items()}


def tokens(text):
    """(ids and byte ranges of A, of B) of the whole text, or None."""
    if not text:
        return None
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    a_raw = [b"".join(LETTERS[c] for c in A.id_to_token(i)) for i in a]
    b_raw = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    want = (" " + text).encode()
    if b"".join(a_raw) != want or b"".join(b_raw) != want:
        return None

    def ranges(ids, raw):
        ends = list(accumulate(map(len, raw)))
        return list(zip(ids, [0, *ends], ends))
    return ranges(a, a_raw), ranges(b, b_raw)


def brute_all(texts):
    """Per text the expected figures: all pairs, whole texts."""
    rows, count = [], Counter()
    for text in texts:
        got = tokens(text)
        if got is None:
            rows.append(None)
            continue
        a, b = got
        common = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = []
        for lo, hi in zip([0, *common], common):
            groups.append(",".join(str(i) for i, s, e in a if lo < e <= hi) + "|" + ",".join(str(i) for i, s, e in b if lo < e <= hi))
        near = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        count.update(near)
        rows.append((len(a), len(b), groups, near))
    best = {}
    for (_, j), n in count.items():
        best[j] = max(best.get(j, 0), n)
    out = []
    for r in rows:
        if r is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, near = r
        out.append((n_a, n_b, len(groups), len(near), sum(count[p] == best[p[1]] for p in near), sum(count[p] for p in near),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


def test_query_against_brute_force(spark):
    # Short texts only here; the next test has the whole table against the library's ids.
    rows = [tuple(r) for r in spark.read.parquet(f"{DOCS}/documents.parquet").select("doc_id", "text").collect() if len(r[1]) < 1500]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: tuple(r)[1:] for r in alignment.align(docs, BOTH).collect()}
    assert got == dict(zip([d for d, _ in rows], brute_all([t for _, t in rows])))


def test_whole_table_against_the_libraries(spark):
    texts = dict(spark.read.parquet(f"{DOCS}/documents.parquet").select("doc_id", "text").collect())
    got = op13_token_alignment(spark, DOCS).collect()
    assert {r["doc_id"] for r in got} == set(texts) and len(got) == len(texts)
    total = 0
    for r in got:
        a, b = tokens(texts[r["doc_id"]]) or ([], [])
        assert (r["n_a"], r["n_b"]) == (len(a), len(b))
        assert r["n_groups"] == len({e for *_, e in a} & {e for *_, e in b})
        assert r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"]
        total += r["n_links"]
    # Every link counts once for each link of its pair.
    assert sum(r["count_sum"] for r in got) >= total and all(0 <= r["n_best"] <= r["n_links"] for r in got)


def units_equal_whole(text):
    units = ALIGNER.units(" " + text)
    assert "".join(units) == " " + text
    ids = [sum((encode(u) for u in units), []) for encode in (ALIGNER.encode_a, ALIGNER.encode_b)]
    assert ids[0] == A.encode(" " + text, add_special_tokens=False).ids
    if tokens(text):
        assert ids[1] == B.encode(text)


def check_together(texts):
    """Units of several texts, learnt at once, against each text on its own."""
    got = alignment.Aligner(BOTH).block(texts)
    for text, n_a, n_b, n_groups, digest in zip(texts, got["n_a"], got["n_b"], got["n_groups"], got["groups_sha256"]):
        want = brute_all([text])[0]
        assert (n_a, n_b, n_groups, digest) == (*want[:3], want[6])


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab'st1 \t\n\r\x0b\x1c\x85\xa0 　▁<|endoftext|>é̈ß日😀{});"), min_size=1, max_size=50))
def test_units_are_tokenized_as_in_the_whole_text(text):
    units_equal_whole(text)


@settings(max_examples=300, deadline=None)
@given(st.text(min_size=1, max_size=40))
def test_units_of_any_text(text):
    units_equal_whole(text)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab's \t\n\x85\xa0▁é̈日{}"), max_size=30), max_size=12))
def test_units_of_many_texts_at_once(texts):
    check_together(texts)


ends = st.lists(st.integers(1, 40), max_size=20).map(set)


@settings(max_examples=300, deadline=None)
@given(ends, ends, st.integers(41, 50))
def test_divide_and_conquer_finds_every_shared_end(x, y, last):
    a, b = sorted(x | {last}), sorted(y | {last})
    want = [(a.index(e) + 1, b.index(e) + 1) for e in sorted(set(a) & set(b))]
    assert alignment.shared_ends(a, b) == want
    links = list(zip(*(v.tolist() for v in alignment.links_of(np.array(a), np.array(b)))))
    spans = [list(zip([0, *v], v)) for v in (a, b)]
    assert links == [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e]


def test_leaf_without_cuts():
    a, b = list(range(1, 20_001, 2)), [*range(2, 20_000, 2), 19_999]
    assert alignment.shared_ends(a, b) == [(len(a), len(b))]
    assert alignment.shared_ends([], []) == []


def test_odd_rows_clashing_names_and_empty_table(spark):
    rows = [*ODD, (30, " "), (31, "a "), (32, "a  "), (33, "\n"), (34, "a\n\n b \n"), (35, "a <s> <0x0A> <|endoftext|> </s>"),
            (36, "▁"), (37, "a▁b"), (38, "\x00 a"), (39, "tab\t \tx  \n y"), (40, "lone " * 3000)]
    rows = [(d, t) for d, t in rows if t is None or len(t) < 60_000]
    docs = spark.createDataFrame([(d, t, 1, 2, 3, "x") for d, t in rows],
                                 "doc_id long, text string, block long, n long, k int, ids string").repartition(3)
    got = sorted(str(tuple(r)) for r in alignment.align(docs, BOTH).collect())
    assert got == sorted(str((d, *f)) for (d, _), f in zip(rows, brute_all([t for _, t in rows])))
    assert alignment.align(odd_frame(spark), BOTH).count() == len(ODD)
    assert alignment.align(empty_frame(spark), BOTH).count() == 0


def test_small_cache_gives_the_same(monkeypatch):
    texts = ["one two three " * 5, "four five six", "one two", None, "seven eight\nnine", "one two three " * 5]
    want = [ALIGNER.block([t]) for t in texts]
    monkeypatch.setattr(alignment, "CACHE", 2)
    monkeypatch.setattr(alignment, "TOGETHER", 1)
    small = alignment.Aligner(BOTH)
    for w, t in zip(want, texts):
        g = small.block([t])
        assert g.pop("groups_sha256") == w.pop("groups_sha256")
        for c in ("n_a", "n_b", "n_groups", "pair_a", "pair_b", "pair_total"):
            assert g[c].tolist() == w[c].tolist()


def test_a_block_has_a_small_row_for_each_text(spark):
    """no row holds the units of a whole block, and none is gathered in memory."""
    texts = [f"text number {k} has word{k} and word{k + 1} " * 20 for k in range(300)] + [None, "", "lone " * 70_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = alignment.align_blocks(docs, BOTH).collect()
    assert [r["id"] for r in rows] == list(range(len(texts)))
    assert max(len(r["pairs"]) + len(r["times"]) for r in rows) < 2_000
    first = [r["id"] for r in rows if r["pair_a"] is not None]
    assert len(first) == len({r["block"] for r in rows}) < 5
    plan = alignment.align(docs, BOTH)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
    got = {r["doc_id"]: tuple(r)[1:] for r in alignment.align(docs, BOTH).collect()}
    some = [0, 7, 300, 301]
    want = brute_all([t for t in texts[:302]] + ["lone"])
    assert [got[k][:4] + got[k][6:] for k in some] == [want[k][:4] + want[k][6:] for k in some]
    assert got[302][0] == len(A.encode(" " + texts[302], add_special_tokens=False).ids)


def test_texts_are_taken_apart_in_bounded_parts(monkeypatch):
    """a task holds the units of so many characters, and of what it keeps."""
    texts = ["one two three " * 5, "four five six", None, "one two " + "x" * 80, "seven eight\nnine", "one two three " * 5, "four five six"]
    want = alignment.Aligner(BOTH).block(texts)
    monkeypatch.setattr(alignment, "APART", 20)
    monkeypatch.setattr(alignment, "CACHE", 4)
    sizes, aligner = [], alignment.Aligner(BOTH)
    some = aligner.some
    monkeypatch.setattr(aligner, "some", lambda part: sizes.append(len(part)) or some(part))
    got = aligner.block(texts)
    assert max(sizes) <= 3 and sum(sizes) == len(texts)
    assert {c: list(v) for c, v in got.items()} == {c: list(v) for c, v in want.items()}
