"""report formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clock_label(hour: Column) -> Column:
    """``HH:00``, or ``N/A`` where the hour is NULL."""
    return F.coalesce(F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00")), F.lit("N/A"))


def money(x: Column, digits: int = 4) -> Column:
    return F.format_string(f"%.{digits}f", x)
