"""A5 + F7: z-score outlier removal per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..util import quote
from .chunks import CHUNK, CHUNK_WIDTH, KEY, chunked, join_facts, like, over_series, per_chunk


def zscore_stats(df: DataFrame, columns: Sequence[str], *, keys=("home_id",)) -> DataFrame:
    """A5: mean and sample standard deviation per series and column (long)."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std")]
    wide = df.groupBy(*keys).agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__mean`, `{c}__std`" for c in columns)
    return wide.selectExpr(*[f"`{k}`" for k in keys],
                           f"stack({len(columns)}, {stack}) AS (column, mean, std)")


def _moments(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per chunk, the statistics of its series: ``_n0, _m0, _s0, _n1, ...`` (count,
    mean, sample deviation), put together from the chunks' own moments."""
    aggregates, first, second, third = {}, {}, {}, {}
    for i, c in enumerate(columns):
        q = quote(c)
        aggregates |= {f"_c{i}": F.expr(f"count({q})"), f"_a{i}": F.expr(f"avg({q})"), f"_v{i}": F.expr(f"var_pop({q})"),
                       f"_lo{i}": F.expr(f"min({q})"), f"_hi{i}": F.expr(f"max({q})")}
        n, a, v = F.col(f"_c{i}"), F.col(f"_a{i}"), F.col(f"_v{i}")
        first |= {f"_n{i}": over_series(F.sum(n)), f"_t{i}": over_series(F.sum(n * a)),
                  f"_lo{i}": over_series(F.min(f"_lo{i}")), f"_hi{i}": over_series(F.max(f"_hi{i}"))}
        # Equal values: their mean is that value, their spread nothing, to the last digit.
        same = F.col(f"_lo{i}") == F.col(f"_hi{i}")
        second |= {f"_m{i}": F.when(same, F.col(f"_lo{i}")).otherwise(F.try_divide(f"_t{i}", f"_n{i}"))}
        spread = over_series(F.sum(n * v + n * (a - F.col(f"_m{i}")) ** 2))
        third |= {f"_s{i}": F.when(F.col(f"_n{i}") > 1, F.when(same, F.lit(0.0)).otherwise(
            F.sqrt(F.try_divide(spread, F.col(f"_n{i}") - 1))))}
    facts = per_chunk(rows, aggregates).withColumns(first).withColumns(second).withColumns(third)
    return facts.select(KEY, CHUNK, *(f"_{x}{i}" for i in range(len(columns)) for x in "nms"))


def remove_outliers(df: DataFrame, columns: Sequence[str], threshold: float = 3.0, *,
                    keys=("home_id",), ts="ts", keep_constant: bool = False,
                    skip_empty: bool = True, width=CHUNK_WIDTH) -> DataFrame:
    """Filter on :func:`outlier_flags`."""
    return (outlier_flags(df, columns, threshold, keys=keys, ts=ts, keep_constant=keep_constant, skip_empty=skip_empty, width=width)
            .filter("_keep").drop("_keep"))


def outlier_flags(df: DataFrame, columns: Sequence[str], threshold: float = 3.0, *,
                  keys=("home_id",), ts="ts", keep_constant: bool = False,
                  skip_empty: bool = True, width=CHUNK_WIDTH) -> DataFrame:
    """Add ``_keep``: |z| < threshold in every column (strict).

    J9: the statistics of a series are put together from those of its chunks
    and joined back to the rows.  A NULL z (NULL value, zero or undefined std)
    drops the row, as NaN comparisons do in the reference; with
    ``keep_constant`` columns of zero spread are ignored instead.
    ``skip_empty`` ignores a column that has no value at all in a series (a
    channel the home does not have).
    """
    rows = chunked(df, keys, ts, width)
    joined = join_facts(rows, _moments(rows, columns))
    conds = []
    for i, c in enumerate(columns):
        std = F.col(f"_s{i}")
        cond = F.abs(F.try_divide(F.col(c) - F.col(f"_m{i}"), std)) < F.lit(float(threshold))
        if keep_constant:
            cond = F.when(F.coalesce(std, F.lit(0.0)) == 0, F.lit(True)).otherwise(cond)
        if skip_empty:
            cond = F.when(F.col(f"_n{i}") == 0, F.lit(True)).otherwise(cond)
        conds.append(F.coalesce(cond, F.lit(False)))
    keep = conds[0]
    for c in conds[1:]:
        keep = keep & c
    flagged = joined.withColumn("_keep", keep).drop(*(f"_{x}{i}" for i in range(len(columns)) for x in "nms"))
    return like(df, flagged)


def outlier_removal_counts(df: DataFrame, columns: Sequence[str], threshold: float = 3.0, *,
                           keys=("home_id",), **kw) -> DataFrame:
    """A7 for the z-score filter in one pass: the keep flag is a column and
    one aggregate counts rows before (all) and after (kept)."""
    flagged = outlier_flags(df, columns, threshold, keys=keys, **kw)
    counts = flagged.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_before"),
                                        F.sum(F.col("_keep").cast("long")).alias("n_after"))
    removed = F.col("n_before") - F.col("n_after")
    return counts.select(*keys, "n_before", "n_after", removed.alias("n_removed"),
                         (removed / F.col("n_before") * 100).alias("pct_removed"))
