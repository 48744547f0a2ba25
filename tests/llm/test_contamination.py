import random

import pytest
from pyspark.sql import functions as F

from wattgrid.llm import contamination as ct
from wattgrid.llm.oracle import SQL
from wattgrid.llm.queries import op3_near_duplicates, op5_decontamination

from .helpers import DOCS, contaminated, empty_frame, letters_words, odd_frame


def test_query_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DOCS}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{DOCS}/benchmark.parquet").select("item_id", "text").collect()]
    want = contaminated(docs, items)
    got = {r["doc_id"]: r for r in op5_decontamination(spark, DOCS).collect()}
    assert {d: (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for d, r in got.items()} == {
        d: (n, h, len(i), h > 0) for d, (n, h, i) in want.items()}
    assert any(r["contaminated"] for r in got.values())


@pytest.mark.parametrize("query", [op3_near_duplicates, op5_decontamination])
def test_query_against_sql(spark, query):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DOCS}/{t}.parquet'")
    want = con.execute(SQL[query.__name__])
    names = [d[0] for d in want.description]
    assert sorted(tuple(r) for r in query(spark, DOCS).select(*names).collect()) == sorted(want.fetchall())


def test_random_texts(spark):
    rnd = random.Random(8)
    text = lambda n: " ".join(rnd.choice("aa bb Cc d9 éé".split()) for _ in range(n))
    docs = [(i, text(rnd.randrange(0, 40))) for i in range(80)]
    items = [(i, text(rnd.choice([0, 1, 2, 3, 4, 6]))) for i in range(25)] + [(3, "aa bb"), (None, "d9 d9 d9"), (99, None), (98, "...")]
    got = ct.contamination(spark.createDataFrame(docs, "doc_id long, text string"),
                           spark.createDataFrame(items, "item_id long, text string"), window=4).collect()
    want = contaminated(docs, items, 4)
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], sorted(set(r["items"]))) for r in got} == {
        d: (n, h, sorted(set(i))) for d, (n, h, i) in want.items()}


def test_words(spark):
    texts = ["", None, "  !? ", "Ab-cD é9É x", "\x00a\x7f", "ÀB", "_under_score_"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", ct.words_of(F.col("t")).alias("w")).collect()
    assert {r["i"]: r["w"] for r in got} == {i: letters_words(t) for i, t in enumerate(texts)}


def test_odd_rows_and_empty_tables(spark):
    df = odd_frame(spark)
    items = spark.createDataFrame([(1, "brown fox jumps"), (2, "a"), (None, "x")], "item_id long, text string")
    got = ct.contamination(df, items).collect()
    assert len(got) == df.count()
    by = {r["doc_id"]: r for r in got}
    assert by[1]["items"] == ["1"] and by[1]["n_hit"] == 3 and by[7]["items"] == ["2"] and by[8]["n_hit"] == 1
    assert not by[3]["contaminated"] and by[10]["n_words"] == 24000
    none = spark.createDataFrame([], "item_id long, text string")
    assert ct.contamination(df, none).where("contaminated or n_hit > 0").count() == 0
    assert ct.contamination(empty_frame(spark), items).count() == 0


def test_no_python_on_the_main_path(spark):
    docs = spark.read.parquet(f"{DOCS}/documents.parquet")
    plan = ct.contamination(docs, spark.read.parquet(f"{DOCS}/benchmark.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))
