"""Driver queries of the operators: each applies its operator to the whole
of its table and derives the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, contamination, fill_middle, fingerprints, language, licenses, near_duplicates, quality, repeats,
               sentencepiece, sharding, token_counts, toxicity)
from .common import documents, labels, public_file, remainder, table, training_sample
from .oracle import SQL


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    found = language.identify(docs, language.fit_dictionaries(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(documents(spark, sf_dir), shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(documents(spark, sf_dir), similarity=0.85)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    model = toxicity.fit(training_sample(docs, labels(spark, sf_dir), "toxic", ~held_out,
                                         per_class=(3000, 1500), max_chars=4000))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = contamination.contamination(docs, table(spark, sf_dir, "benchmark"), window=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op6_token_counts(spark: SparkSession, sf_dir: str, tokenizer: str | None = None, limit: int = 2048) -> DataFrame:
    """``tokenizer``: path of the tokenizer's file; None: the public one."""
    counts = token_counts.count_tokens(documents(spark, sf_dir), tokenizer or public_file("word_bpe_49k.json"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return fingerprints.fingerprint_chain(docs, fingerprints.lexicon(docs))


def op8_sentencepiece(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """``model``: path of the SentencePiece model; None: the public one."""
    pieces = sentencepiece.Pieces.load(model or public_file("piece_bpe_32k.model"))
    return sentencepiece.encode(documents(spark, sf_dir), pieces)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"), width=200).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    weights = quality.fit(training_sample(docs, labels(spark, sf_dir), "quality", ~held_out))
    return quality.score(docs, weights).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(documents(spark, sf_dir), rate=50, suffix_first=80, seed=42)
    restored = fill_middle.restore(F.col("output"), F.col("form"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(restored.cast("binary"), 256).alias("restored_sha256"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


def op13_token_alignment(spark: SparkSession, sf_dir: str, a: str | None = None, b: str | None = None) -> DataFrame:
    """``a``, ``b``: paths of the tokenizers' files; None: the public ones."""
    both = alignment.Tokenizers.load(a or public_file("byte_bpe_50k.json"), b or public_file("piece_bpe_32k.model"))
    return alignment.align(documents(spark, sf_dir), both)


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_sharding, op3_near_duplicates, op4_toxicity, op5_decontamination, op6_token_counts, op7_fingerprints, op8_sentencepiece, op9_quality,
    op10_suffix_dedup, op11_fill_in_middle, op12_license_scan, op13_token_alignment)}
__all__ = ["QUERIES", "SQL"]
