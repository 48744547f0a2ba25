"""Lag, rolling and future-target features over each series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..util import quote
from .chunks import CHUNK_WIDTH, HIDDEN, IN_BLOCK, like, windowed


def lag_columns(columns: Sequence[str], lags: Sequence[int], *, available: Sequence[str] | None = None) -> dict[str, Column]:
    """``{c}_lag_{k}`` = the value k rows back (rows, not time).

    Columns not in ``available`` are skipped, as the reference skips them."""
    return {f"{c}_lag_{k}": F.expr(f"lag({quote(c)}, {int(k)}) {IN_BLOCK})")
            for c in columns if available is None or c in available for k in lags}


def _back(c: str, k: int) -> str:
    return f"_{c}_back_{k}"


def back_columns(columns: Sequence[str], windows: Sequence[int], *, available: Sequence[str] | None = None) -> dict[str, Column]:
    """The values that the longest of the windows reaches, a column each; for
    :func:`with_rolling`."""
    return {_back(c, k): F.expr(f"lag({quote(c)}, {k}) {IN_BLOCK})")
            for c in columns if available is None or c in available for k in range(1, max(windows, default=1))}


def with_rolling(df: DataFrame, columns: Sequence[str], windows: Sequence[int], *, available: Sequence[str] | None = None) -> DataFrame:
    """Trailing mean, sum and sample std over ``w`` rows, current included,
    at least one value (std of one value is NULL).

    From the values of :func:`back_columns`, the oldest first: a frame would be
    summed anew for each row and function.  The helper columns are dropped."""
    every = [(c, int(w)) for c in columns if available is None or c in available for w in windows]

    def values(c: str, w: int) -> list[str]:
        return [*(quote(_back(c, k)) for k in range(w - 1, 0, -1)), quote(c)]

    def added(terms: list[str]) -> str:
        return " + ".join(terms)
    whole = {f.name for f in df.schema.fields if isinstance(f.dataType, IntegralType)}
    counts, sums, means, squares, stds = {}, {}, {}, {}, {}
    for c, w in every:
        n, total, mean = f"_{c}_n_{w}", f"{c}_rolling_sum_{w}", f"{c}_rolling_mean_{w}"
        got = [f"CAST({v} AS {'BIGINT' if c in whole else 'DOUBLE'})" for v in values(c, w)]
        counts[n] = F.expr(added([f"CAST({v} IS NOT NULL AS INT)" for v in got]))
        sums[total] = F.expr(f"CASE WHEN coalesce({', '.join(reversed(got))}) IS NOT NULL THEN {added([f'coalesce({v}, 0)' for v in got])} END")
        means[mean] = F.expr(f"CASE WHEN {quote(n)} > 0 THEN {quote(total)} / {quote(n)} END")
        squares[f"_{c}_q_{w}"] = F.expr(added([f"coalesce(({v} - {quote(mean)}) * ({v} - {quote(mean)}), 0D)" for v in got]))
        stds[f"{c}_rolling_std_{w}"] = F.expr(f"CASE WHEN {quote(n)} > 1 THEN sqrt({quote(f'_{c}_q_{w}')} / ({quote(n)} - 1)) END")
    own = [c for c in df.columns if c not in back_columns(columns, windows, available=available)]
    order = [f"{c}_rolling_{s}_{w}" for c, w in every for s in ("mean", "sum", "std")]
    made = df.withColumns({**counts, **sums}).withColumns(means).withColumns(squares).withColumns(stds) if every else df
    return made.select(*(quote(c) for c in (*own, *order)))


def target_column(target: str, horizon: int = 4) -> Column:
    """The value ``horizon`` rows ahead."""
    return F.expr(f"lead({quote(target)}, {int(horizon)}) {IN_BLOCK})")


def add_lag_features(df: DataFrame, columns, lags, *, keys=("home_id",), ts="ts", width=CHUNK_WIDTH) -> DataFrame:
    made = windowed(df, lambda: lag_columns(columns, lags, available=df.columns), keys, ts, max(lags, default=0), 0, width)
    return like(df, made)


def add_rolling_features(df: DataFrame, columns, windows, *, keys=("home_id",), ts="ts", width=CHUNK_WIDTH) -> DataFrame:
    made = windowed(df, lambda: back_columns(columns, windows, available=df.columns), keys, ts,
                    max(windows, default=1) - 1, 0, width)
    return like(df, with_rolling(made, columns, windows, available=df.columns))


def add_target(df: DataFrame, target: str, horizon: int = 4, *, keys=("home_id",), ts="ts", width=CHUNK_WIDTH) -> DataFrame:
    return like(df, windowed(df, lambda: {"target": target_column(target, horizon)}, keys, ts, 0, horizon, width))


def feature_names(df: DataFrame, *, keys=("home_id",), ts="ts") -> list[str]:
    """Every column but keys, time and target is a feature."""
    skip = {*keys, ts, "target", "split", *HIDDEN}
    return [c for c in df.columns if c not in skip]


def prepare_features(df: DataFrame, target: str, channels: Sequence[str],
                     lags: Sequence[int] = (1, 2, 3, 4), windows: Sequence[int] = (4, 8, 12),
                     horizon: int = 4, *, keys=("home_id",), ts="ts", width=CHUNK_WIDTH) -> DataFrame:
    """Lags, rolling statistics and target in a single projection (all
    frames share one partitioning and one sort), then drop rows whose target
    or any feature is missing (P9)."""
    own = [c for c in channels if c in df.columns]
    made = windowed(df, lambda: {**lag_columns(own, lags), **back_columns(own, windows), "target": target_column(target, horizon)},
                    keys, ts, max([*lags, *(w - 1 for w in windows)], default=0), horizon, width)
    # Where a value is there, so are its rolling mean and sum; where one of the
    # lags that its window reaches is there too, so is the deviation.
    implied = {f"{c}_rolling_{s}_{w}" for c in own for w in windows for s in ("mean", "sum", "std")
               if s != "std" or any(k < w for k in lags)}
    helpers = back_columns(own, windows)
    needed = [c for c in feature_names(made, keys=keys, ts=ts) if c not in helpers]
    rolled = with_rolling(made.dropna(subset=["target", *needed]), own, windows)
    rolled = rolled.select(*(quote(c) for c in rolled.columns if c != "target"), "target")
    rest = [f"{c}_rolling_std_{w}" for c in own for w in windows if f"{c}_rolling_std_{w}" not in implied]
    return like(df, rolled.dropna(subset=rest) if rest else rolled)
