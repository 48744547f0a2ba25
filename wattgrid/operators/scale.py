"""A6 + F6: min-max scaling, with a reusable params table (FX8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import TIME_FEATURES
from ..util import numeric_columns, quote
from .chunks import CHUNK, CHUNK_WIDTH, HIDDEN, KEY, chunked, join_facts, keyed, like, over_series, per_chunk


def default_scale_columns(df: DataFrame, keys=("home_id",), ts="ts") -> list[str]:
    """All numeric columns but keys and calendar features."""
    return numeric_columns(df, exclude=(*keys, ts, *TIME_FEATURES, *HIDDEN))


def _scaled(c, lo, hi):
    rng = hi - lo
    # A zero range scales to x - min (0 on the fitted data), not to 0.5.
    return (F.col(c) - lo) / F.when(rng == 0, F.lit(1.0)).otherwise(rng)


def minmax_scale(df: DataFrame, columns: Sequence[str] | None = None, *,
                 keys=("home_id",), ts="ts", width=CHUNK_WIDTH) -> DataFrame:
    """Fit and transform: the extremes of a series are those of its chunks,
    joined back to the rows (J9)."""
    cols = list(columns) if columns is not None else default_scale_columns(df, keys, ts)
    rows = chunked(df, keys, ts, width)
    aggregates = {}
    for i, c in enumerate(cols):
        aggregates |= {f"_lo{i}": F.expr(f"min({quote(c)})"), f"_hi{i}": F.expr(f"max({quote(c)})")}
    facts = per_chunk(rows, aggregates).select(KEY, CHUNK, *(
        over_series(f(F.col(f"_{x}{i}"))).alias(f"_{x}{i}") for i in range(len(cols)) for f, x in ((F.min, "lo"), (F.max, "hi"))))
    scaled = join_facts(rows, facts).withColumns({c: _scaled(c, F.col(f"_lo{i}"), F.col(f"_hi{i}")) for i, c in enumerate(cols)})
    return like(df, scaled.drop(*(f"_{x}{i}" for i in range(len(cols)) for x in ("lo", "hi"))))


def fit_minmax(df: DataFrame, columns: Sequence[str] | None = None, *,
               keys=("home_id",), ts="ts") -> DataFrame:
    """Params table ``(keys..., column, data_min, data_max)``."""
    cols = list(columns) if columns is not None else default_scale_columns(df, keys, ts)
    aggs = []
    for c in cols:
        aggs += [F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max")]
    stack = ", ".join(f"'{c}', `{c}__min`, `{c}__max`" for c in cols)
    return (df.groupBy(*keys).agg(*aggs)
            .selectExpr(*[f"`{k}`" for k in keys],
                        f"stack({len(cols)}, {stack}) AS (column, data_min, data_max)"))


def apply_minmax(df: DataFrame, params: DataFrame, columns: Sequence[str], *,
                 keys=("home_id",)) -> DataFrame:
    """Transform with a fitted params table; values outside the fitted range
    are not clipped.  The params are pivoted to one row per series (small:
    one row per home) and joined on the keys, null keys too; AQE broadcasts it
    when its measured size allows."""
    cols = list(columns)
    wide = (params.filter(F.col("column").isin(cols))
            .groupBy(*keys)
            .agg(*[F.max(F.when(F.col("column") == c, F.col("data_min"))).alias(f"__lo_{c}") for c in cols],
                 *[F.max(F.when(F.col("column") == c, F.col("data_max"))).alias(f"__hi_{c}") for c in cols]))
    # A null key is a key: both sides meet by the keys as one struct.
    joined = keyed(df, keys).join(keyed(wide, keys).drop(*keys), KEY, "left")
    scaled = joined.withColumns({c: _scaled(c, F.col(f"__lo_{c}"), F.col(f"__hi_{c}")) for c in cols})
    return like(df, scaled.drop(*[f"__{s}_{c}" for c in cols for s in ("lo", "hi")]))
