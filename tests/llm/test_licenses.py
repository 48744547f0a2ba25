import random

import pytest

from wattgrid.llm import licenses
from wattgrid.llm.licenses import NOTICES, PHRASES, Template
from wattgrid.llm.queries import op12_license_scan

from .helpers import DOCS, ODD, empty_frame, letters_words, odd_frame


def brute(text, phrases=PHRASES, notices=NOTICES):
    """All windows of all texts, one after the other."""
    words = letters_words(text)
    places, labels, score = [], set(), 0.0
    base = set()
    for p in phrases:
        k = len(p.words)
        found = [s for s in range(len(words) - k + 1) if words[s:s + k] == p.words]
        if found:
            places += found
            base.add(p.label)
            score = 1.0
    for tpl in notices:
        k, want = len(tpl.words), set(tpl.words)
        share = max((len(want & set(words[max(0, e - k):e])) for e in range(1, len(words) + 1)), default=0)
        if share >= tpl.need:
            labels.add(tpl.label)
            score = max(score, share / len(want))
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | labels)), pytest.approx(score))


def check(rows, got):
    def key(r):
        return (str(r[0]), str(r[1:-1]))
    want = sorted(((d, *brute(t)) for d, t in rows), key=key)
    assert sorted(map(tuple, got), key=key) == want


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DOCS}/documents.parquet").select("doc_id", "text").collect()]
    got = op12_license_scan(spark, DOCS).collect()
    check(rows, got)
    assert any(r["n_base"] for r in got)


def planted(seed):
    """Notices cut short, with words changed, moved, repeated, over one another."""
    rng = random.Random(seed)
    filler = "the of and software free alpha beta this license under terms gnu general by cc".split()
    rows = []
    for d in range(120):
        parts = []
        for _ in range(rng.randint(0, 4)):
            words = rng.choice((*PHRASES, *NOTICES)).text.split()
            for _ in range(rng.randint(0, len(words) // 3)):
                at = rng.randrange(len(words))
                words[at:at + 1] = rng.choice([[], [rng.choice(filler)], [words[at]] * 2, [words[at].upper()]])
            parts += words + rng.choices(filler, k=rng.randint(0, 12))
        rows.append((d, rng.choice([" ", "\n", " - "]).join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_changed_notices(spark, seed):
    rows = planted(seed)
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    check(rows, got)
    assert len({r["labels"] for r in got}) > 10


def test_odd_rows_clashing_names_and_empty_table(spark):
    rows = [*ODD, (20, "mit license " * 30_000), (21, "MIT LICENSEé mit license mit-license"), (21, "cc by cc by"),
            (21, "cc by cc by"), (None, "cc by")]
    docs = spark.createDataFrame([(d, t, 1, "w", "l", 2, 3) for d, t in rows],
                                 "doc_id long, text string, row int, words string, label string, n int, t int")
    check(rows, licenses.scan_licenses(docs).collect())
    assert licenses.scan_licenses(odd_frame(spark)).count() == len(ODD)
    assert licenses.scan_licenses(empty_frame(spark)).count() == 0


def test_other_templates(spark):
    """One word, repeated words, a word many texts have, thresholds of all kinds."""
    phrases = (Template("twice", "again and again", phrase=True), Template("one", "the", phrase=True))
    notices = (Template("half", "one two three four", threshold=0.5), Template("any", "five six seven", threshold=0.01),
               Template("rep", "a a a b", threshold=0.75))
    rng = random.Random(5)
    words = "again and the one two three four five six seven a b x y".split()
    rows = [(d, " ".join(rng.choices(words, k=rng.randint(0, 25)))) for d in range(200)]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), phrases, notices).collect()

    def key(r):
        return r[0]
    assert sorted(map(tuple, got), key=key) == [(d, *brute(t, phrases, notices)) for d, t in rows]


def test_main_path_is_native(spark):
    plan = licenses.scan_licenses(odd_frame(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
