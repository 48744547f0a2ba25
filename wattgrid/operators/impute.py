"""Missing-value handling over each series, chunk by chunk.

A chunk's edge values (its first and last non-null value of each column) go
into a small table; carried along the series there, they fill what a chunk
cannot fill from its own rows.  No task holds a whole series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..util import epoch_seconds, quote
from .chunks import (CHUNK, CHUNK_WIDTH, KEY, chunked, earlier, first_of_series, join_facts, last_of_series, later, like,
                     per_chunk, so_far)

METHODS = ("ffill", "bfill", "interpolate", "drop")


def _edges(rows: DataFrame, columns: Sequence[str], ts: str) -> DataFrame:
    """First and last value of each column in a chunk, and their times:
    ``_fv0, _ft0, _lv0, _lt0, _fv1, ...``."""
    aggregates = {}
    for i, c in enumerate(columns):
        at = f"CASE WHEN {quote(c)} IS NOT NULL THEN {quote(ts)} END"
        aggregates |= {f"_fv{i}": F.expr(f"min_by({quote(c)}, {at})"), f"_ft{i}": F.expr(f"min({at})"),
                       f"_lv{i}": F.expr(f"max_by({quote(c)}, {at})"), f"_lt{i}": F.expr(f"max({at})")}
    return per_chunk(rows, aggregates)


def forward_fill(df: DataFrame, columns: Sequence[str], *, keys=("home_id",), ts="ts", width=CHUNK_WIDTH) -> DataFrame:
    """Forward fill, then backward fill what is still missing at the start."""
    rows = chunked(df, keys, ts, width)
    facts = _edges(rows, columns, ts).select(KEY, CHUNK, *(
        F.coalesce(earlier(F.col(f"_lv{i}")), first_of_series(F.col(f"_fv{i}"))).alias(f"_e{i}") for i in range(len(columns))))
    filled = join_facts(rows, facts).withColumns(
        {c: F.coalesce(F.expr(f"last({quote(c)}, true) {so_far(ts)}"), F.col(f"_e{i}")) for i, c in enumerate(columns)})
    return like(df, filled.drop(*(f"_e{i}" for i in range(len(columns)))))


def backward_fill(df: DataFrame, columns: Sequence[str], *, keys=("home_id",), ts="ts", width=CHUNK_WIDTH) -> DataFrame:
    """Backward fill, then forward fill what is still missing at the end."""
    rows = chunked(df, keys, ts, width)
    facts = _edges(rows, columns, ts).select(KEY, CHUNK, *(
        F.coalesce(later(F.col(f"_fv{i}")), last_of_series(F.col(f"_lv{i}"))).alias(f"_e{i}") for i in range(len(columns))))
    filled = join_facts(rows, facts).withColumns(
        {c: F.coalesce(F.expr(f"last({quote(c)}, true) {so_far(ts, desc=True)}"), F.col(f"_e{i}")) for i, c in enumerate(columns)})
    return like(df, filled.drop(*(f"_e{i}" for i in range(len(columns)))))


def interpolate_time(df: DataFrame, columns: Sequence[str], *, keys=("home_id",), ts="ts", width=CHUNK_WIDTH) -> DataFrame:
    """Linear in time between the previous and next valid points.

    Leading gaps stay NULL; trailing gaps hold the last valid value.
    """
    rows = chunked(df, keys, ts, width)
    facts = []
    for i in range(len(columns)):
        last = F.when(F.col(f"_lt{i}").isNotNull(), F.struct(epoch_seconds(F.col(f"_lt{i}")).alias("t"), F.col(f"_lv{i}").alias("v")))
        first = F.when(F.col(f"_ft{i}").isNotNull(), F.struct(epoch_seconds(F.col(f"_ft{i}")).alias("t"), F.col(f"_fv{i}").alias("v")))
        facts += [earlier(last).alias(f"_e{i}"), later(first).alias(f"_n{i}")]
    joined = join_facts(rows, _edges(rows, columns, ts).select(KEY, CHUNK, *facts))
    t = epoch_seconds(F.col(ts))
    points = {}
    for i, c in enumerate(columns):
        point = f"CASE WHEN {quote(c)} IS NOT NULL THEN struct(unix_micros(CAST({quote(ts)} AS TIMESTAMP)) / 1000000.0D AS t, {quote(c)} AS v) END"
        points |= {f"_e{i}": F.coalesce(F.expr(f"last({point}, true) {so_far(ts)}"), F.col(f"_e{i}")),
                   f"_n{i}": F.coalesce(F.expr(f"last({point}, true) {so_far(ts, desc=True)}"), F.col(f"_n{i}"))}
    staged = joined.withColumns(points)
    out = {}
    for i, c in enumerate(columns):
        p, n = F.col(f"_e{i}"), F.col(f"_n{i}")
        frac = (t - p["t"]) / (n["t"] - p["t"])
        out[c] = (F.when(F.col(c).isNotNull(), F.col(c))
                  .when(p.isNull(), F.lit(None).cast("double"))
                  .when(n.isNull(), p["v"])
                  .otherwise(p["v"] + (n["v"] - p["v"]) * frac))
    return like(df, staged.withColumns(out).drop(*(f"_{s}{i}" for i in range(len(columns)) for s in "en")))


def drop_missing(df: DataFrame, columns: Sequence[str], **_) -> DataFrame:
    """Drop rows with any missing value."""
    return df.dropna(how="any", subset=list(columns))


def handle_missing(df: DataFrame, columns: Sequence[str], method: str = "ffill", *,
                   keys=("home_id",), ts="ts", width=CHUNK_WIDTH) -> DataFrame:
    """Dispatcher.  An unknown method is always an error."""
    if method not in METHODS:
        raise ValueError(f"no fill method {method!r}; there are {METHODS}")
    fn = {"ffill": forward_fill, "bfill": backward_fill,
          "interpolate": interpolate_time, "drop": drop_missing}[method]
    return fn(df, columns, keys=keys, ts=ts, width=width)
