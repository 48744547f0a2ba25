"""Benchmark passages in documents by a prefix-filtered set join, in DataFrame
functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

BINS = 1 << 17
SALTS = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_OUTSIDE = "".join(chr(c) for c in [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def words_of(text: Column) -> Column:
    """Words of letters a-z (A-Z lower-cased), digits and non-ASCII characters;
    none for null."""
    inner = F.btrim(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(_OUTSIDE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1))


def windows_of(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """``(item, w, words)``: every ``window`` consecutive words of an item, or
    all words of a shorter one; ``w`` names the window (its words, with blanks)."""
    split = items.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words"))
    starts = F.expr(f"sequence(1, greatest(1, size(words) - {window - 1}))")
    return (split.where("size(words) > 0").select("item", "words", F.explode(starts).alias("s"))
            .select("item", F.slice("words", F.col("s"), F.lit(window)).alias("words"))
            .select("item", F.array_join("words", " ").alias("w"), "words").distinct())


def _bins(words: DataFrame) -> Column:
    """A table of ``BINS`` bytes that tells whether a word's bin holds any of
    the ``words``: a filter of fixed size, whatever their number."""
    table = bytearray(BINS)
    for (b,) in words.select(F.pmod(F.hash("word"), F.lit(BINS))).distinct().collect():
        table[b] = 1
    return F.lit(bytes(table))


def _listed(word: Column, table: Column) -> Column:
    return F.substring(table, F.pmod(F.hash(word), F.lit(BINS)) + 1, 1) == F.lit(b"\x01")


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(id_col, row_key, n_words, n_hit, items, contaminated)`` for every row.

    A text contains a window if it has all its words, in their order and next
    to each other.  For that it must have the window's rarest word (the prefix
    of its words ordered by their count in all documents, as long as full
    containment needs it), at the place the window gives it, and room for the
    window before and after.  So: words of the documents that are in the
    benchmark are counted; each window is joined through its rarest word only
    (windows with a word that no document has are out); candidates are checked
    for room and word by word.  A hot word is dealt over ``SALTS`` parts.

    ``n_hit``: words inside any contained window.  ``items``: their item ids as
    strings, sorted.  ``row_key``: hash of id and text.  Null, empty and
    wordless texts have no words and no hits; items without words have no
    windows; a null item id hits but is not listed.  Repeated rows count each;
    repeated items count once.  Other columns are not read."""
    windows = cut(windows_of(items, window, item_id_col, item_text_col))
    named = windows.select("w", "words").distinct()
    tokens = named.select("w", "words", F.posexplode("words").alias("pos", "word"))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("k"),
                       words_of(F.col(text_col)).alias("words"))

    in_benchmark = _bins(tokens)
    counts = (rows.select(F.explode("words").alias("word")).where(_listed(F.col("word"), in_benchmark))
              .groupBy("word").agg(F.count("*").alias("n")))
    known = cut(tokens.select("word").distinct().join(counts, "word"))
    # The rarest word of each window; windows with an absent word cannot occur.
    ranked = tokens.join(known, "word", "left").groupBy("w").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "pos")).alias("r"), F.first("words").alias("words"))
    prefixes = cut(ranked.where("r.n > 0").select("w", "words", F.col("r.word").alias("word"), F.col("r.pos").alias("pos")))

    table = _bins(prefixes)
    places = F.filter(F.expr("sequence(1, size(words))"), lambda i: _listed(F.element_at("words", i), table))
    reach = window - 1
    found = F.transform(F.when(F.size("words") > 0, places), lambda i: F.struct(
        i.alias("at"), F.element_at("words", i).alias("word"), F.greatest(i - reach, F.lit(1)).alias("from"),
        F.slice("words", F.greatest(i - reach, F.lit(1)), F.lit(2 * reach + 1)).alias("near")))
    scanned = cut(rows.select("id", "k", F.size("words").cast("long").alias("n_words"), found.alias("found")))

    candidates = (scanned.select("k", "n_words", F.inline("found"))
                  .withColumn("salt", F.pmod(F.xxhash64("k", "at"), F.lit(SALTS)).cast("int")))
    salted = prefixes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    start = F.col("at") - F.col("pos")
    size = F.size("words")
    hits = (candidates.join(salted, ["word", "salt"])
            .where((start >= 1) & (start + size - 1 <= F.col("n_words")))
            .where(F.slice("near", F.greatest(start - F.col("from") + 1, F.lit(1)), size) == F.col("words"))
            .select("k", start.alias("s"), (start + size).alias("e"), "w"))
    hits = cut(hits.distinct())

    so_far = Window.partitionBy("k").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    covered = (hits.select("k", "s", "e").distinct()
               .withColumn("done", F.coalesce(F.max("e").over(so_far), F.lit(0)))
               .groupBy("k").agg(F.sum(F.greatest(F.lit(0), F.col("e") - F.greatest("s", "done"))).cast("long").alias("n_hit")))
    listed = (hits.select("k", "w").distinct().join(windows.select("w", "item"), "w")
              .groupBy("k").agg(F.array_sort(F.collect_set("item")).alias("items")))
    return (scanned.select("id", "k", "n_words").join(covered.join(listed, "k"), "k", "left")
            .select(F.col("id").alias(id_col), F.col("k").alias("row_key"), "n_words",
                    F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    F.col("n_hit").isNotNull().alias("contaminated")))
