"""Shards of nearly equal size by longest-processing-time scheduling."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from .common import cut

LEVELS = 11


def longest_first(sizes: list[tuple[int, object]], shards: int) -> dict[object, int]:
    """Largest item first, each to the shard with the least load so far (a
    heap; equal loads: the lower shard; equal sizes: in the order of names)."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for size, name in sorted(sizes, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        out[name] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def _bundle(digest, width: int):
    """Bundle of a small group: half of all groups share the first ``width``
    bundles, a quarter the next ``width`` and so on, so bundles come in falling
    sizes and the last ones placed even out the loads."""
    hi = F.conv(F.hex(F.substring(digest, 1, 4)), 16, 10).cast("long")
    lo = F.conv(F.hex(F.substring(digest, 5, 4)), 16, 10).cast("long")
    level = F.least(F.lit(LEVELS - 1), F.lit(32) - F.length(F.conv(hi.cast("string"), 10, 2)))
    level = F.when(hi == 0, F.lit(LEVELS - 1)).otherwise(level)
    return F.coalesce((level * width + lo % width).cast("int"), F.lit(0))  # null texts: no digest


def shard_rows(docs: DataFrame, shards: int = 24, large: int = 1000, width: int = 1024,
               rows_per_block: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, size, text_crc32, shard, slot)`` for every row.

    Groups (rows of equal text) stay together; a row's size is its text's
    UTF-8 bytes (null: none) plus 8.  Groups of at least a ``1 / (shards *
    large)`` part of the total are placed one by one: there cannot be more than
    ``shards * large`` of them, whatever the table's size, so they fit the
    driver.  All smaller groups are joined into ``11 * width`` bundles by a
    digest of the text.  Both go to the least-loaded shard, largest first.
    One rule at all sizes; on a small table nearly every group is a large one.

    ``slot`` numbers a shard's rows from 0 without gaps: rows are counted per
    (shard, block), blocks start where the ones before end, and rows are
    numbered within their block only, so no task holds a whole shard.

    Null texts are one group.  ``text_crc32`` of a null text is null.  Repeated
    rows each get a slot.  An empty table gives an empty result."""
    digest = F.coalesce(F.unhex(F.sha2(F.col(text_col).cast("binary"), 256)), F.lit(b"").cast("binary"))
    rows = docs.select(
        F.col(id_col).alias(id_col), digest.alias("_g"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.col(text_col).cast("binary")).alias("text_crc32"))
    spark = docs.sparkSession
    groups = cut(rows.groupBy("_g").agg(F.sum("size").alias("total"), F.count("*").alias("n")))
    whole = groups.agg(F.sum("total").alias("total"), F.sum("n").alias("n")).first()
    total, count = whole["total"] or 0, whole["n"] or 0
    is_large = F.col("total") * F.lit(shards * large) >= F.lit(total)
    split = groups.withColumn("_b", F.when(~is_large, _bundle(F.col("_g"), width)))
    items = (split.groupBy(F.when(is_large, F.col("_g")).alias("g"), F.col("_b").alias("b"))
             .agg(F.sum("total").alias("total")).collect())  # at most shards * large + 11 * width rows
    placed = longest_first([(r["total"], (1, bytes(r["g"]), 0) if r["b"] is None else (0, b"", r["b"]))
                            for r in items], shards)
    single = spark.createDataFrame([(g, s) for (k, g, _), s in placed.items() if k],
                                   StructType([StructField("_g", BinaryType()), StructField("_s1", IntegerType())]))
    bundled = spark.createDataFrame([(b, s) for (k, _, b), s in placed.items() if not k],
                                    StructType([StructField("_b", IntegerType()), StructField("_s2", IntegerType())]))
    blocks = max(1, -(-count // rows_per_block))
    homed = (rows.withColumn("_b", _bundle(F.col("_g"), width))
             .join(F.broadcast(single), "_g", "left").join(F.broadcast(bundled), "_b", "left")
             .select(id_col, "size", "text_crc32", F.coalesce("_s1", "_s2").alias("shard"),
                     F.pmod(F.xxhash64(id_col, "text_crc32"), F.lit(blocks)).alias("_block")))
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (homed.groupBy("shard", "_block").agg(F.count("*").alias("_n"))
              .select("shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_at")))
    inside = Window.partitionBy("shard", "_block").orderBy(id_col, "text_crc32", "size")
    return (homed.withColumn("_k", F.row_number().over(inside) - 1)
            .join(starts, ["shard", "_block"])
            .select(id_col, "size", "text_crc32", "shard", (F.col("_at") + F.col("_k")).cast(LongType()).alias("slot")))
