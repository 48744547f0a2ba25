"""What the operators share: tables, batch sizes, lineage cuts, row keys."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..session import configure, materialize
from ..sources.tables import table

ARROW_ROWS = 1000
ARROW_BYTES = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches (long texts), and the package on the executors."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(prepare(spark), sf_dir, "documents")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(prepare(spark), sf_dir, "labels")


def public_file(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def cut(df: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder and read again."""
    return materialize(df)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def with_id(docs: DataFrame, id_col: str, rest: str) -> StructType:
    """Schema of an id column as ``docs`` has it, and of further columns."""
    return StructType([StructField(id_col, docs.schema[id_col].dataType), *StructType.fromDDL(rest)])


def map_arrow(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]],
              schema: str | StructType) -> DataFrame:
    """``make()`` runs once in each task and returns the function that turns a
    batch into a batch (or None)."""
    def run(batches):
        each = make()
        for batch in batches:
            if batch.num_rows:
                out = each(batch)
                if out is not None:
                    yield out
    return df.mapInArrow(run, schema)


def training_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column,
                    per_class: tuple[int, int] = (3000, 3000), max_chars: int = 20_000) -> list[tuple[str, int]]:
    """At most ``per_class`` rows of class 0 and of class 1: the labels with the least
    hash of their id among those that ``keep`` (a condition on ``doc_id``)
    admits, and their texts, at most ``max_chars`` characters each.  This
    bounds what reaches the driver; scoring reads whole texts.  Null ids,
    labels and texts are left out; a repeated label row counts once."""
    chosen = labels.select("doc_id", F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    chosen = chosen.where(keep).distinct()
    order = F.xxhash64("doc_id", F.lit(11))
    few = chosen.where("y = 0").orderBy(order, "doc_id").limit(per_class[0]).unionByName(
        chosen.where("y = 1").orderBy(order, "doc_id").limit(per_class[1]))
    got = (docs.select("doc_id", "text").where("text is not null").join(F.broadcast(few), "doc_id")
           .select(order.alias("h"), "doc_id", F.substring("text", 1, max_chars).alias("text"), "y").collect())
    got.sort(key=lambda r: (r["h"], r["doc_id"], r["text"], r["y"]))
    return [(r["text"], r["y"]) for r in got]
