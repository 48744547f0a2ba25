"""Calendar fields and their cyclic encodings."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def calendar_columns(ts: str = "ts") -> dict[str, Column]:
    t = F.col(ts)
    hour = F.hour(t).cast("long")
    dow = F.weekday(t).cast("long")  # Monday = 0
    two_pi = F.lit(2 * math.pi)
    return {
        "hour": hour,
        "day_of_week": dow,
        "day_of_month": F.dayofmonth(t).cast("long"),
        "month": F.month(t).cast("long"),
        "is_weekend": (dow >= 5).cast("long"),
        "hour_sin": F.sin(two_pi * hour / 24),
        "hour_cos": F.cos(two_pi * hour / 24),
        "day_sin": F.sin(two_pi * dow / 7),
        "day_cos": F.cos(two_pi * dow / 7),
    }


def add_time_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    """the nine calendar features, in one projection."""
    return df.withColumns(calendar_columns(ts))
