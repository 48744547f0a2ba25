"""Small shared helpers: interval parsing, window specs, column lists."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

_UNITS = {
    "s": 1, "sec": 1, "secs": 1, "second": 1, "seconds": 1, "S": 1,
    "t": 60, "T": 60, "min": 60, "mins": 60, "minute": 60, "minutes": 60,
    "h": 3600, "H": 3600, "hour": 3600, "hours": 3600,
    "d": 86400, "D": 86400, "day": 86400, "days": 86400,
}


def interval_seconds(interval: str | int) -> int:
    """'15min', '1H', '15 minutes', '30s' or seconds -> whole seconds."""
    if isinstance(interval, int):
        return interval
    m = re.fullmatch(r"\s*(\d*)\s*([A-Za-z]+)\s*", str(interval))
    if not m or m.group(2) not in _UNITS:
        raise ValueError(f"Unsupported interval: {interval!r}")
    n = int(m.group(1) or 1)
    if n <= 0:
        raise ValueError(f"Interval must be positive: {interval!r}")
    return n * _UNITS[m.group(2)]


def seconds_interval(seconds: int) -> Column:
    """A DAY TO SECOND interval literal of ``seconds``."""
    return F.expr(f"INTERVAL '{int(seconds)}' SECOND")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since epoch (double) of a timestamp_ntz under a UTC session."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1_000_000.0)


def series_window(keys: Sequence[str], ts: str = "ts", desc: bool = False):
    order = F.col(ts).desc() if desc else F.col(ts).asc()
    return Window.partitionBy(*keys).orderBy(order)


def running(keys: Sequence[str], ts: str = "ts", desc: bool = False):
    """Growing frame: start of the series (or its end, if ``desc``) to the row."""
    return series_window(keys, ts, desc).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def whole(keys: Sequence[str]):
    return Window.partitionBy(*keys)


def nan_to_null(c: Column) -> Column:
    """NaN is the only missing value of the reference; Spark wants NULL."""
    return F.nanvl(c, F.lit(None).cast("double"))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in exclude]


def value_columns(df: DataFrame, keys: Sequence[str], ts: str = "ts") -> list[str]:
    return numeric_columns(df, exclude=(*keys, ts))


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def over_sql(keys: Sequence[str], ts: str | None = "ts", rows: tuple[int, int] | None = None,
             desc: bool = False) -> str:
    """``OVER (...)`` text of the series window.  Many window columns are
    cheaper to declare as SQL text (``F.expr``): one call each instead of a
    chain of Column-building calls from Python."""
    frame = ""
    if rows is not None:
        lo, hi = rows
        start = "UNBOUNDED PRECEDING" if lo is None else ("CURRENT ROW" if lo == 0 else f"{-lo} PRECEDING")
        end = "CURRENT ROW" if hi == 0 else f"{hi} FOLLOWING"
        frame = f" ROWS BETWEEN {start} AND {end}"
    order = f" ORDER BY {quote(ts)} {'DESC' if desc else 'ASC'}" if ts else ""
    return f"OVER (PARTITION BY {', '.join(quote(k) for k in keys)}{order}{frame})"
