"""A training-corpus pipeline: five stages over the ``documents`` table.

``STAGES`` lists them in order; each takes ``(spark, docs, sf_dir)``, works on
all rows it gets and returns a DataFrame, which ``run`` writes as Parquet and
reads again for the next.  All stages but the last return the columns of
``documents``.  No stage has SQL for its result (models, sketches, byte
ranges), so the tests hold the pipeline against brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattgrid.llm import contamination, language, near_duplicates, repeats, sentencepiece
from wattgrid.llm.common import cut, documents, prepare, public_file, table

#: Fixed by the task: near-duplicate stages take five words and 0.8.
SIMILARITY, SHINGLE = 0.8, 5
REPEAT_BYTES = 200
WINDOW = 10


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is told apart; dictionaries come from a
    bounded sample of the labelled rows.  Rejected rows go: no letter, null
    text, or best and second best encoding within half a hundredth of each other.
    If no row has text and language, all go."""
    prepare(spark)
    whole = docs.select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("row"), "text")
    found = language.identify(whole, language.fit_dictionaries(docs), id_col="row")
    return found.where(~F.col("rejected")).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps, of each group that links of similarity 0.8 connect, the document
    with the least id (equal ids: by a hash of the row).  Rows that repeat a
    whole document are one.  Documents without words are linked with nothing."""
    prepare(spark)
    named = docs.withColumn("_id", F.struct(F.col("doc_id"), F.xxhash64("doc_id", "text").alias("k")))
    groups = near_duplicates.near_duplicates(named, SIMILARITY, SHINGLE, id_col="_id")
    kept = groups.where("kept").select(F.col("_id.doc_id").alias("_d"), F.col("_id.k").alias("_k"))
    rows = docs.withColumn("_k0", F.xxhash64("doc_id", "text"))
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_k0") == F.col("_k"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", "_k0"]).select(docs.columns)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes every string of 200 bytes that starts at two or more places out of
    the texts, as far as whole characters go; all rows stay."""
    prepare(spark)
    done = repeats.remove_repeats(docs, REPEAT_BYTES)
    length = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    return done.select(*(F.col("kept_text").alias("text") if c == "text" else
                         F.when(F.col("n_removed") > 0, length).otherwise(F.col(c)).alias(c) if c == "n_chars" else
                         F.col(f"`{c}`") for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain ten consecutive words of a benchmark item,
    or all words of a shorter item.  An empty benchmark drops nothing."""
    prepare(spark)
    found = contamination.contamination(docs, table(spark, sf_dir, "benchmark"), WINDOW)
    hit = found.where("contaminated").select("row_key").distinct()
    return docs.join(hit, F.xxhash64("doc_id", "text") == F.col("row_key"), "left_anti").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text under the public SentencePiece model, and whether they
    decode to the text.  Null text: null ids."""
    prepare(spark)
    pieces = sentencepiece.Pieces.load(public_file("piece_bpe_32k.model"))
    named = docs.select(F.struct("doc_id", "lang", "source").alias("row"), "text")
    return sentencepiece.encode(named, pieces, id_col="row").select("row.*", "n_tokens", "ids", "round_trip")


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", remove_repeats),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
