"""Writers.  The writer creates the output directory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, *, single_file: bool = False, mode: str = "overwrite") -> str:
    """CSV with a header and no index column.  ``single_file`` is for small
    report tables only (one task writes it)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, *, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path
