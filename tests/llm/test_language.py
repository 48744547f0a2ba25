import pytest
import zstandard
from pyspark.sql import functions as F

from wattgrid.llm import language
from wattgrid.llm.queries import op1_language_id

from .helpers import DOCS, ODD, empty_frame, odd_frame, remainder


@pytest.fixture(scope="module")
def result(spark):
    docs = spark.read.parquet(f"{DOCS}/documents.parquet").select("doc_id", "lang", "text")
    return docs.join(op1_language_id(spark, DOCS), "doc_id").collect()


def test_whole_table_and_held_out_flag(result, spark):
    assert len(result) == spark.read.parquet(f"{DOCS}/documents.parquet").count()
    assert all(r["held_out"] == (remainder(r["doc_id"], 3) == 1) for r in result)
    assert all(0 <= r["score"] <= 1 for r in result)


def test_held_out_accuracy(result):
    held = [r for r in result if r["held_out"]]
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.95


def test_smallest_encoding_wins(spark):
    dictionaries = {"a": b"red green blue " * 30, "b": b"one two three " * 30}
    rows = [(1, "red green blue red green"), (2, "three two one two three one")]
    got = {r["doc_id"]: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string"), dictionaries).collect()}
    for i, text in rows:
        sizes = {}
        for name, raw in dictionaries.items():
            d = zstandard.ZstdCompressionDict(raw + language.MARK, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            c = zstandard.ZstdCompressor(level=6, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)
            sizes[name] = len(c.compress(language.MARK + text.encode()))
        assert got[i]["lang_pred"] == min(sizes, key=sizes.get)
        assert got[i]["margin"] == pytest.approx(1 - min(sizes.values()) / max(sizes.values()))
    assert not got[1]["rejected"]


def test_narrow_margin_is_rejected(spark):
    same = {"a": b"red green blue " * 30, "b": b"red green blue " * 30}
    row = language.identify(spark.createDataFrame([(1, "red green")], "doc_id long, text string"), same).first()
    assert (row["lang_pred"], row["margin"], row["rejected"]) == ("a", 0.0, True)


def test_odd_rows(spark):
    df = odd_frame(spark)
    found = language.identify(df, language.fit_dictionaries(df)).collect()
    assert len(found) == len(ODD)
    und = {r["doc_id"] for r in found if r["lang_pred"] == language.UNDETERMINED}
    assert und == {3, 4, 5, 6, 13, None}
    assert all(r["rejected"] for r in found if r["lang_pred"] == language.UNDETERMINED)
    assert len({(r["lang_pred"], r["score"]) for r in found if r["doc_id"] == 1}) == 1


def test_empty_table(spark):
    df = empty_frame(spark)
    dictionaries = language.fit_dictionaries(df)
    assert dictionaries == {}
    assert language.identify(df, dictionaries).count() == 0
    assert language.identify(odd_frame(spark), dictionaries).where(F.col("lang_pred") != "und").count() == 0


def test_too_many_languages_raise(spark):
    df = spark.createDataFrame([(str(i), f"word {i} text") for i in range(5)], "lang string, text string")
    with pytest.raises(ValueError):
        language.fit_dictionaries(df, max_languages=3)
