"""A2 resample mean (left-closed, left-labelled bins) and A3 gap filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from ..util import epoch_seconds, interval_seconds, quote, seconds_interval
from .chunks import CHUNK, CHUNK_WIDTH, IN_CHUNK, KEY, along, chunked, keyed, like, over_series, per_chunk


def bin_start(df: DataFrame, interval: str | int, *, keys: Sequence[str] = ("home_id",),
              ts: str = "ts", out: str = "_bin") -> DataFrame:
    """Add the start of the bin each row falls into.

    Bins are anchored at midnight of the first day of each series, as the
    reference's resampler does.  When the interval divides a day that is the
    same as anchoring at the epoch, so the bin is a per-row expression.
    Otherwise the per-series first day is one small aggregate joined back on
    the keys (AQE broadcasts it when its measured size is small).
    """
    secs = interval_seconds(interval)
    if 86400 % secs == 0:
        return df.withColumn(out, F.window(F.col(ts), f"{secs} seconds").start)
    rows = keyed(df, keys)  # a null key is a key
    first_day = (rows.groupBy(KEY).agg(F.min(ts).alias("_first"))
                 .select(KEY, F.window("_first", "1 day").start.alias("_origin")))
    offset = F.floor((epoch_seconds(F.col(ts)) - epoch_seconds(F.col("_origin"))) / F.lit(secs))
    start = F.col("_origin") + F.make_dt_interval(secs=(offset * F.lit(secs)).cast("decimal(18,6)"))
    return rows.join(first_day, KEY).withColumn(out, start).drop("_origin", KEY)


def resample_mean(wide: DataFrame, channels: Sequence[str], interval: str | int = "15min", *,
                  keys: Sequence[str] = ("home_id",), ts: str = "ts",
                  fill_gaps: bool = True, width=CHUNK_WIDTH, keep_chunks: bool = False) -> DataFrame:
    """Mean per bin and channel; with ``fill_gaps`` every bin between the
    first and the last bin of a series is present (all-NULL where empty).
    ``keep_chunks`` keeps the hidden columns for the steps that follow.

    Shuffle: one hash exchange on (keys, bin) after a map-side partial
    average, so raw readings are reduced before they move.  The means are written
    before gaps are filled: what follows reads them several times, and raw
    readings only once.
    """
    binned = bin_start(wide, interval, keys=keys, ts=ts)
    out = (binned.groupBy(*keys, F.col("_bin").alias(ts))
           .agg(*[F.avg(c).alias(c) for c in channels]))
    if keep_chunks:
        out = chunked(out, keys, ts, width)
    return fill_bins(materialize(out), channels, interval, keys=keys, ts=ts, width=width) if fill_gaps else out


def fill_bins(binned: DataFrame, channels: Sequence[str], interval: str | int, *,
              keys: Sequence[str] = ("home_id",), ts: str = "ts", width=CHUNK_WIDTH) -> DataFrame:
    """A3: every bin between the first and the last bin of a series, all-NULL
    where it was missing.

    Chunk by chunk: the small table tells the first and last bin that a chunk
    must have (chunks without a row too); each present bin expands to itself and
    the missing ones up to the next."""
    secs, wide = interval_seconds(interval), interval_seconds(width)
    step = seconds_interval(secs)
    rows = chunked(binned.where(F.col(ts).isNotNull()), keys, ts, width)
    ends = per_chunk(rows, {"_lo": F.min(ts), "_hi": F.max(ts)})
    every = ends.withColumns({"_behind": F.coalesce(F.lead(CHUNK).over(along()) - 1, F.col(CHUNK)),
                              "_lo": over_series(F.min("_lo")), "_hi": over_series(F.max("_hi"))})
    every = every.select(KEY, F.explode(F.sequence(F.col(CHUNK), F.col("_behind"))).alias(CHUNK), "_lo", "_hi")

    def grid(steps):  # the bin of the series that many steps from its first
        return F.col("_lo") + F.make_dt_interval(secs=(steps * F.lit(secs)).cast("decimal(18,6)"))

    start = epoch_seconds(F.col("_lo"))
    first = F.ceil((F.col(CHUNK) * wide - start) / F.lit(float(secs)))
    last = F.ceil(((F.col(CHUNK) + 1) * wide - start) / F.lit(float(secs))) - 1
    facts = every.select(*(F.col(f"{KEY}.{quote(k)}").alias(k) for k in keys), KEY, CHUNK,
                         F.greatest(F.col("_lo"), grid(first)).alias("_from"), F.least(F.col("_hi"), grid(last)).alias("_to"))
    joined = facts.join(rows.drop(*keys), [KEY, CHUNK], "left")
    order = f"{IN_CHUNK} ORDER BY {quote(ts)})"
    staged = joined.withColumns({
        "_from": F.when(F.expr(f"row_number() {order}") == 1, F.col("_from")).otherwise(F.col(ts)),
        "_to": F.coalesce(F.expr(f"lead({quote(ts)}) {order}") - step, F.col("_to"))})
    expanded = staged.select(*keys, KEY, CHUNK, F.col(ts).alias("_present"), *channels,
                             F.explode(F.sequence(F.col("_from"), F.col("_to"), step)).alias(ts))
    same = F.col(ts) == F.col("_present")
    return like(binned, expanded.select(*keys, ts, *[F.when(same, F.col(c)).alias(c) for c in channels], KEY, CHUNK))


def count_missing(df: DataFrame, columns: Sequence[str], *,
                  keys: Sequence[str] = ("home_id",)) -> DataFrame:
    """A4: missing cells per series, and row count."""
    cells = sum((F.col(c).isNull().cast("long") for c in columns), F.lit(0).cast("long"))
    return df.groupBy(*keys).agg(F.sum(cells).alias("n_missing"), F.count(F.lit(1)).alias("n_rows"))




def resample_readings(readings: DataFrame, channels: Sequence[str], interval: str | int = "15min", *,
                      unique: bool = False, keys: Sequence[str] = ("home_id",), ts: str = "ts",
                      channel: str = "channel", value: str = "watts", order: str = "seq",
                      fill_gaps: bool = True, width=CHUNK_WIDTH, keep_chunks: bool = False) -> DataFrame:
    """A1 + A2 (+ A3) from long readings.

    ``unique=False`` (default) is the reference's order: first reading per
    (keys, ts, channel), then bin means.  Its first shuffle carries every raw
    reading keyed by (keys, ts), where partial aggregation cannot reduce much.

    ``unique=True`` is for sources that guarantee one reading per (keys,
    channel, ts) (a primary key): the first reading *is* the reading, so the
    bin means come straight from the long rows.  Map-side partial averages
    reduce raw readings to one partial per (keys, bin) and task before the
    single shuffle.  Null readings are dropped first in both paths, so bins
    holding only nulls do not exist (as after the pivot)."""
    if not unique:
        from .pivot import pivot_first

        wide = pivot_first(readings, channels, keys=keys, ts=ts, channel=channel, value=value, order=order)
        return resample_mean(wide, channels, interval, keys=keys, ts=ts, fill_gaps=fill_gaps, width=width, keep_chunks=keep_chunks)
    src = readings.filter(F.col(value).isNotNull() & F.col(channel).isin(list(channels)))
    binned = bin_start(src, interval, keys=keys, ts=ts)
    out = binned.groupBy(*keys, F.col("_bin").alias(ts)).agg(
        *[F.avg(F.when(F.col(channel) == F.lit(c), F.col(value))).alias(c) for c in channels])
    if keep_chunks:
        out = chunked(out, keys, ts, width)
    return fill_bins(materialize(out), channels, interval, keys=keys, ts=ts, width=width) if fill_gaps else out
