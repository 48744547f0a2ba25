import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattgrid.llm import fill_middle
from wattgrid.llm.queries import op11_fill_in_middle

from .helpers import DOCS, ODD, empty_frame, odd_frame

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, rate=50, suffix_first=80, seed=42):
    """(n, form, prefix_chars, middle_chars, output) by a loop over units."""
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = [m.group() for m in UNIT.finditer(text)]
    assert "".join(units) == text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    if h[3] % 100 < suffix_first:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_query_against_brute_force(spark):
    texts = dict(spark.read.parquet(f"{DOCS}/documents.parquet").select("doc_id", "text").collect())
    got = op11_fill_in_middle(spark, DOCS).collect()
    assert len(got) == len(texts)
    forms = set()
    for r in got:
        n, form, p, m, output = brute(r["doc_id"], texts[r["doc_id"]])
        assert tuple(r)[1:] == (n, form, p, m, sha(output), sha(texts[r["doc_id"]]))
        forms.add(form)
    assert forms == {"plain", "psm", "spm"}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab \t\n\r\x0b\x0c\x1c\x85\xa0<P>é\U0001F600"), max_size=60), st.integers(1, 12))
def test_units_of_any_text_in_stretches_of_any_size(text, stretch):
    want = [m.end() for m in UNIT.finditer(text)]
    assert fill_middle.unit_ends(text).tolist() == want
    assert fill_middle.unit_ends(text, stretch).tolist() == want


def test_very_long_texts():
    for text in ("ab cd\n" * 400_000, "x" * 3_000_000, " " * 3_000_000, " " * 2_000_000 + "y"):
        ends = fill_middle.unit_ends(text)
        assert ends[-1] == len(text) and len(ends) == sum(1 for _ in UNIT.finditer(text))


def test_odd_rows_marks_and_empty_table(spark):
    rows = [*ODD, *((100 + i, t) for i, t in enumerate(
        ["a <P> b", "a <S> b", "<M>", "a <p> <P <S M> < P>", "ends in <", "<S <M", "é\U0001F600 日 本 " * 9] * 8))]
    docs = spark.createDataFrame([(d, t, "x", "psm", 1) for d, t in rows], "doc_id long, text string, form string, output string, n int")
    # Of every row: a rate of 100 leaves only empty and marked texts plain.
    made = fill_middle.fill_in_middle(docs, rate=100, suffix_first=50)
    got = made.withColumn("back", fill_middle.restore(F.col("output"), F.col("form"))).collect()
    want = sorted(map(str, ((d, t or "", *brute(d, t, 100, 50), t or "") for d, t in rows)))
    assert sorted(str(tuple(r)) for r in got) == want
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(odd_frame(spark)).count() == len(ODD)
    assert fill_middle.fill_in_middle(empty_frame(spark)).count() == 0
