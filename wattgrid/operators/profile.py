"""Profile of a series frame (describe-style summary, date range, head)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def unpivot(df: DataFrame, columns: Sequence[str], *, keys=("home_id",), ts: str | None = "ts",
            name: str = "channel", value: str = "watts") -> DataFrame:
    ids = [*keys, *([ts] if ts else [])]
    return df.unpivot(ids, list(columns), name, value)


QUARTILES = (0.25, 0.5, 0.75)
#: Ranges that a group's values are counted in, per round.
RANGES = 4096


def describe(df: DataFrame, columns: Sequence[str], *, keys=("home_id",), exact: bool = False) -> DataFrame:
    """count, mean, std, min, quartiles, max per (keys, column).

    Quartiles are approximate by default (a bounded sketch per group).
    ``exact=True`` interpolates linearly between the values of the two ranks
    around each, as the reference does (:func:`exact_quantiles`)."""
    if exact:
        df = materialize(df.select(*keys, *columns))  # read once per round
    long = unpivot(df, columns, keys=keys, ts=None, name="column", value="_v")
    aggregates = [F.count("_v").alias("count"), F.avg("_v").alias("mean"), F.stddev_samp("_v").alias("std"),
                  F.min("_v").cast("double").alias("min"), F.max("_v").cast("double").alias("max")]
    shown = [f"q{int(100 * q)}" for q in QUARTILES]
    if not exact:
        sketch = F.percentile_approx(F.col("_v"), list(QUARTILES), 10000).cast("array<double>")
        agg = long.groupBy(*keys, "column").agg(*aggregates, sketch.alias("_q"))
        quartiles = [F.col("_q")[i].alias(n) for i, n in enumerate(shown)]
        return agg.select(*keys, "column", "count", "mean", "std", "min", *quartiles, "max")
    group = F.struct(*keys, "column")
    agg = long.groupBy(*keys, "column").agg(*aggregates).withColumn("_g", group)
    found = exact_quantiles(long.select(group.alias("_g"), F.col("_v").cast("double").alias("_v")), QUARTILES)
    quartiles = [F.col("_q")[i].alias(n) for i, n in enumerate(shown)]
    return agg.join(found, "_g", "left").select(*keys, "column", "count", "mean", "std", "min", *quartiles, "max")


def exact_quantiles(values: DataFrame, quantiles: Sequence[float], ranges: int = RANGES) -> DataFrame:
    """``(_g, _q)`` of ``(_g, _v)``: the quantiles of each group as an array, by
    rank selection.

    A wanted rank starts with the whole range of its group.  Each round counts
    the values of the range in ``ranges`` equal parts (one aggregate, whatever
    the group's size) and goes on with the part that holds the rank, from its
    least to its greatest value, until these are one.  No group's values are
    held or sorted in one place.  Null and NaN values are left out; a group
    without values has no row."""
    known = values.where("_v is not null and not isnan(_v)")
    groups = known.groupBy("_g").agg(F.count("*").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    exact = F.array(*(F.lit(float(q)) * (F.col("n") - 1) for q in quantiles))
    ranks = F.array_distinct(F.flatten(F.transform(exact, lambda r: F.array(F.floor(r), F.ceil(r)))))
    open_ranks = materialize(groups.select("_g", F.explode(ranks).alias("rank"), "lo", "hi", F.lit(0).cast("long").alias("below")))
    done = open_ranks.where("lo = hi").select("_g", "rank", F.col("lo").alias("value"))
    open_ranks = open_ranks.where("lo < hi")
    while not open_ranks.isEmpty():
        part = F.least(F.floor((F.col("_v") / F.lit(2) - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * F.lit(float(ranges))),
                       F.lit(ranges - 1))
        wanted = open_ranks.groupBy("_g", "lo", "hi", "below").agg(F.collect_list("rank").alias("ranks"))
        counted = (known.join(wanted, "_g").where("_v >= lo and _v <= hi")
                   .groupBy("_g", "lo", "hi", "below", "ranks", part.alias("part"))
                   .agg(F.count("*").alias("n"), F.min("_v").alias("least"), F.max("_v").alias("most")))
        order = Window.partitionBy("_g", "lo").orderBy("part")
        before = F.col("below") + F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        inside = (counted.withColumn("before", before).select("_g", F.explode("ranks").alias("rank"), "before", "n", "least", "most")
                  .where("rank >= before and rank < before + n"))
        narrowed = materialize(inside.select("_g", "rank", F.col("least").alias("lo"), F.col("most").alias("hi"), F.col("before").alias("below")))
        done = done.unionByName(narrowed.where("lo = hi").select("_g", "rank", F.col("lo").alias("value")))
        open_ranks = narrowed.where("lo < hi")
    by_rank = done.groupBy("_g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))

    def quantile(q: float):
        r = F.lit(float(q)) * (F.col("n") - 1)
        low, high = F.element_at("at", F.floor(r)), F.element_at("at", F.ceil(r))
        return F.when(low == high, low).otherwise(low + (high - low) * (r - F.floor(r)))
    return by_rank.join(groups.select("_g", "n"), "_g").select("_g", F.array(*(quantile(q) for q in quantiles)).alias("_q"))


def date_range(df: DataFrame, *, keys=("home_id",), ts="ts") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"),
                                 F.max(ts).alias("last_ts"))


def head(df: DataFrame, n: int = 5, *, ts="ts", tie_break: Sequence[str] = ()) -> DataFrame:
    """T4: first ``n`` rows by time (a top-k; the limit is the feature).
    ``tie_break`` orders rows of equal time (e.g. several homes per bin)."""
    return df.orderBy(ts, *tie_break).limit(n)
