"""Sliding sequences for sequence models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..util import quote
from .chunks import CHUNK_WIDTH, IN_BLOCK, OWN, plain, with_borders


def make_sequences(df: DataFrame, features: Sequence[str], length: int = 24, *,
                   target: str = "target", keys=("home_id",), ts="ts",
                   by_split: bool = True, width=CHUNK_WIDTH) -> DataFrame:
    """Rows i..i+L-1 of the features -> target of row i+L.

    Output ``(keys..., [split], ts, x array<array<double>>, y)`` where ``ts``
    is the time of the target row.  Each part of the split is cut on its own,
    as the reference cuts the train, validation and test frames separately.
    Blocks of rows carry the ``length`` rows before them, so no task holds a
    whole series.
    """
    part = [*keys, "split"] if by_split and "split" in df.columns else list(keys)
    spread = with_borders(plain(df), part, ts, before=length, after=0, width=width)
    row = ", ".join(f"CAST({quote(c)} AS DOUBLE)" for c in features)
    x = F.expr(f"collect_list(array({row})) {IN_BLOCK} ROWS BETWEEN {int(length)} PRECEDING AND 1 PRECEDING)")
    out = spread.withColumn("_x", x).where(F.col(OWN) & (F.size("_x") == length))
    return out.select(*part, ts, F.col("_x").alias("x"), F.col(target).cast("double").alias("y"))
