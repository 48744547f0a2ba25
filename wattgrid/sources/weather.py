"""Weather source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..constants import WEATHER_TIME_CANDIDATES
from .readings import _exists


def find_time_column(columns) -> str:
    """``timestamp``, ``datetime``, ``date``, else the first name with
    date/time in it."""
    for c in WEATHER_TIME_CANDIDATES:
        if c in columns:
            return c
    for c in columns:
        if "date" in c.lower() or "time" in c.lower():
            return c
    raise ValueError(f"none of the weather columns holds a time: {list(columns)}")


def load_weather(spark: SparkSession, path: str | None) -> DataFrame | None:
    """``(ts, <numeric weather columns>)`` or None when there is no file.

    Bad content raises (the reference swallowed it)."""
    if not path or not _exists(spark, path):
        return None
    raw = spark.read.option("header", True).option("inferSchema", True).csv(path)
    tcol = find_time_column(raw.columns)
    nums = [f.name for f in raw.schema.fields if isinstance(f.dataType, NumericType) and f.name != tcol]
    return raw.select(F.to_timestamp_ntz(F.col(f"`{tcol}`").cast("string")).alias("ts"),
                      *[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(c)
                        for c in nums])
