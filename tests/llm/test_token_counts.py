import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wattgrid.llm import token_counts
from wattgrid.llm.common import public_file
from wattgrid.llm.queries import op6_token_counts

from .helpers import DOCS, ODD, empty_frame, odd_frame

tokenizers = pytest.importorskip("tokenizers")
PATH = public_file("word_bpe_49k.json")
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
with open(PATH, encoding="utf-8") as f:
    COUNTER = token_counts.PieceCounter(f.read())


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_query_against_the_library(spark):
    texts = dict(spark.read.parquet(f"{DOCS}/documents.parquet").select("doc_id", "text").collect())
    got = {r["doc_id"]: r for r in op6_token_counts(spark, DOCS).collect()}
    assert got.keys() == texts.keys()
    for d, text in texts.items():
        assert (got[d]["n_bytes"], got[d]["n_tokens"]) == (len(text.encode()), library(text))
        assert got[d]["over_limit"] == (got[d]["n_tokens"] > 2048)


@pytest.mark.parametrize("text", [
    "don't we'LL 'SA !'s ''s I'd've", "a<|endoftext|>b", "<|startoftext|>", "x<|endoftext", "½²³ 12 a1b2 ª º µ ß ẞ",
    "\x1c\x1d\x85\xa0 tabs\tand\r\nlines\x0b", "İstanbul ΣΑΣ ſ ŸÅ Å Å", "日本語 中文，。 한국어 \U0001F600‍", "é é ﬁ", "__a_b--c",
])
def test_hard_texts(text):
    assert COUNTER.count([text]) == [library(text)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x24F, exclude_categories=["Cs"]), max_size=40), max_size=5))
def test_latin_texts(texts):
    assert COUNTER.count(texts) == [library(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_any_texts(texts):
    assert COUNTER.count(texts) == [library(t) for t in texts]


def test_odd_rows_and_empty_table(spark):
    got = token_counts.count_tokens(odd_frame(spark), PATH).collect()
    want = sorted(((d if d is not None else -1), len((t or "").encode()), library(t)) for d, t in ODD)
    assert sorted(((r["doc_id"] if r["doc_id"] is not None else -1), r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert token_counts.count_tokens(empty_frame(spark), PATH).count() == 0
