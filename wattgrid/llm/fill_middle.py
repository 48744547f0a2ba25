"""Fill-in-the-middle: texts are cut into units of blanks and a word, and the
parts put into another order behind marks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, with_id

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
STRETCH = 1 << 20
_BLANK = r"\x20\x09-\x0D"
_UNITS = regex.compile(f"([{_BLANK}]*[^{_BLANK}]+|[{_BLANK}]+)*")
#: Where a unit ends whatever stands around it: between a word and a blank.
_EDGE = regex.compile(f"(?<=[^{_BLANK}])(?=[{_BLANK}])")


def unit_ends(text: str, stretch: int = STRETCH) -> np.ndarray:
    """Where each unit of ``text`` ends (code points).  One full match keeps
    every repetition of its group; a text longer than ``stretch`` is matched in
    several, cut where a unit ends in any case, because one match keeps its
    repetitions on a stack of bounded size."""
    if len(text) <= stretch:
        return np.array(_UNITS.fullmatch(text).ends(1), np.int64)
    found, at = [], 0
    while at < len(text):
        edge = _EDGE.search(text, at + stretch) if at + stretch < len(text) else None
        end = edge.start() if edge else len(text)
        found.append(np.array(_UNITS.fullmatch(text, at, end).ends(1), np.int64))
        at = end
    return np.concatenate(found)


def cut_units(rows: DataFrame, id_col: str, text_col: str, first: str, second: str) -> DataFrame:
    """``(id_col, text, n, cut1, cut2)``: the number of units, and where the
    ``first % (n + 1)``-th and the ``second % (n + 1)``-th unit end, the smaller
    place first."""
    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, cuts = [], ([], [])
            for text, a, b in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                ends = unit_ends(text)
                n.append(len(ends))
                at = sorted((a % (len(ends) + 1), b % (len(ends) + 1)))
                for out, k in zip(cuts, at, strict=True):
                    out.append(int(ends[k - 1]) if k else 0)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, pa.int64()) for c in (n, *cuts))],
                names=[id_col, "_text", "n", "_cut1", "_cut2"])
        return each

    return map_arrow(rows.select(id_col, text_col, first, second), make,
                     with_id(rows, id_col, "_text string, n long, _cut1 long, _cut2 long"))


def draws(doc_id: Column, seed: int = 42) -> list[Column]:
    """The first four 8-digit groups of the sha256 of seed, colon and id, as
    integers (null id: as an empty one)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def marked(text: Column) -> Column:
    return F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))


def fill_in_middle(docs: DataFrame, rate: int = 50, suffix_first: int = 80, seed: int = 42,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, text, n, form, prefix_chars, middle_chars, output)`` for every row.

    The draws of an id choose two cuts among the unit ends and the form: of
    ``rate`` percent of the texts the parts are reordered, of these
    ``suffix_first`` percent as ``spm`` (marks: suffix, prefix, middle), the
    others as ``psm``.  Empty texts and texts that contain a mark stay ``plain``:
    output is the text, the lengths are null.

    Null texts count as empty.  Texts of any length are cut whole.  Equal ids
    draw alike, a null id draws as an empty one; repeated rows give a row each;
    an empty table gives none.  No other column is read, so names cannot clash."""
    h = draws(F.col(id_col), seed)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col), text.alias("_text"), h[0].alias("_h1"), h[1].alias("_h2"))
    units = cut_units(rows, id_col, "_text", "_h1", "_h2")

    text = F.col("_text")
    form = (F.when((text == "") | marked(text) | (h[2] % 100 >= rate), "plain")
            .when(h[3] % 100 < suffix_first, "spm").otherwise("psm"))
    formed = units.withColumn("form", form)
    cut1, cut2 = F.col("_cut1").cast("int"), F.col("_cut2").cast("int")
    prefix, middle = F.substring(text, F.lit(1), cut1), F.substring(text, cut1 + 1, cut2 - cut1)
    suffix = F.substring(text, cut2 + 1, F.length(text))
    is_plain = F.col("form") == "plain"
    output = (F.when(is_plain, text)
              .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
              .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)))
    return formed.select(id_col, text.alias("text"), "n", "form", F.when(~is_plain, F.col("_cut1")).alias("prefix_chars"),
                         F.when(~is_plain, F.col("_cut2") - F.col("_cut1")).alias("middle_chars"), output.alias("output"))


def restore(output: Column, form: Column) -> Column:
    """The text that an output of the given form was made of.  The marks occur
    once each (texts that contain one are plain), so they tell the parts."""
    part = F.split(F.substring(output, F.lit(len(PREFIX) + 1), F.length(output)), "<[PSM]>", -1)
    return (F.when(form == "psm", F.concat(part[0], part[2], part[1]))
            .when(form == "spm", F.concat(part[1], part[2], part[0])).otherwise(output))
