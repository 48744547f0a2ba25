"""Language identification by compression.

One raw-content zstandard dictionary per language; a text belongs to the
language whose dictionary makes it smallest, and is rejected where the runner
up is nearly as small."""

from __future__ import annotations

import math

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, with_id

UNDETERMINED = "und"
#: Stands at the end of every dictionary and before every block, so that also a
#: block of a few bytes is encoded (not stored as it is) and sizes can differ.
MARK = bytes(range(160, 224)) * 2


def fit_dictionaries(docs: DataFrame, slots: int = 256, snippet: int = 512,
                     max_languages: int = 64) -> dict[str, bytes]:
    """Dictionary text per language from rows ``(text, lang)``.

    The sample is bounded: rows fall into ``slots`` slots by a hash of the
    text, each slot and language gives one snippet of at most ``snippet``
    characters (the text with the least hash), so at most ``slots * snippet``
    characters per language reach the driver.  Equal texts count once, so
    groups of copies weigh nothing extra.  Rows with null text or lang and
    texts without a letter are left out.  More than ``max_languages``
    languages raise."""
    low = F.lower("text")
    sample = (docs.select("text", "lang").where("text is not null and lang is not null")
              .where(F.col("text").rlike(r"\p{L}"))
              .withColumn("_h", F.xxhash64("text"))
              .withColumn("_s", F.substring(low, 1, snippet))
              .groupBy("lang", F.pmod("_h", F.lit(slots)).alias("slot"))
              .agg(F.min_by("_s", F.struct("_h", "_s")).alias("snippet")))
    parts: dict[str, list[tuple[int, str]]] = {}
    # One row more than can be used, so that too many languages show.
    for lang, slot, text in sample.limit(slots * max_languages + 1).toLocalIterator():
        parts.setdefault(lang, []).append((slot, text))
    if len(parts) > max_languages:
        raise ValueError(f"over {max_languages} languages")
    return {lang: "\n".join(t for _, t in sorted(got)).encode() for lang, got in sorted(parts.items())}


def identify(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = 0.005,
             level: int = 6, tie_level: int = 19, block: int = 8192, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, lang_pred, score, margin, rejected)`` for every row.

    The whole text, lower-cased, is encoded in blocks of ``block`` bytes with
    each dictionary; where the smallest size is not alone, again at
    ``tie_level``, which finds shorter matches.  ``margin``: how much smaller the best encoding is than
    the second, as a share of the second.  ``score``: share of the best
    language when sizes are turned into weights, 0 to 1.  ``rejected``: margin
    under ``min_margin``, or undetermined.  Null text, a text without a letter
    or no dictionary at all: ``und``, score 0, margin 0, rejected.  Ties go to
    the first language in alphabetical order (and are rejected).  Repeated
    rows are scored each.  Columns other than the two named are not read."""
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), letters.alias("letters"))
    names = list(dictionaries)

    def make():
        def compressor(name: str, level: int):
            d = zstandard.ZstdCompressionDict(dictionaries[name] + MARK, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            return zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=False,
                                            write_content_size=False, write_dict_id=False).compress

        packs = [compressor(name, level) for name in names]
        closer = [compressor(name, tie_level) for name in names]

        def score(text: str) -> tuple[str, float, float, bool]:
            raw = text.lower().encode()
            blocks = [MARK + raw[i:i + block] for i in range(0, len(raw), block)]
            sizes = [sum(len(p(b)) for b in blocks) for p in packs]
            if sizes.count(min(sizes)) > 1:
                sizes = [sum(len(p(b)) for b in blocks) for p in closer]
            best = min(sizes)
            at = sizes.index(best)
            rest = [s for i, s in enumerate(sizes) if i != at]
            margin = (min(rest) - best) / min(rest) if rest else 1.0
            width = 0.02 * best + 1.0
            weight = sum(math.exp((best - s) / width) for s in sizes)
            return names[at], 1.0 / weight, margin, margin < min_margin

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            got = [score(t.as_py()) if names and ok.as_py() else (UNDETERMINED, 0.0, 0.0, True)
                   for t, ok in zip(batch.column(1), batch.column(2), strict=True)]
            lang, share, margin, rejected = zip(*got, strict=True)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(share, pa.float64()),
                 pa.array(margin, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[id_col, "lang_pred", "score", "margin", "rejected"])
        return each

    return map_arrow(rows, make, with_id(docs, id_col, "lang_pred string, score double, margin double, rejected boolean"))
