"""A1: long readings -> one column per channel, first reading per (home, ts, channel)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_first(readings: DataFrame, channels: Sequence[str], *,
                keys: Sequence[str] = ("home_id",), ts: str = "ts",
                channel: str = "channel", value: str = "watts",
                order: str = "seq") -> DataFrame:
    """Wide frame with the first non-null reading per (keys, ts, channel).

    ``order`` is the ingest order (or a source key) that defines "first".
    Null readings are dropped first, so a timestamp with only nulls yields
    no row.  One aggregate with a filtered ``min_by`` per channel: a single
    shuffle on (keys, ts) with map-side partial aggregation.
    """
    src = readings.filter(F.col(value).isNotNull() & F.col(channel).isin(list(channels)))
    aggs = [
        F.min_by(F.col(value), F.when(F.col(channel) == F.lit(c), F.col(order))).alias(c)
        for c in channels
    ]
    return src.groupBy(*keys, ts).agg(*aggs)
