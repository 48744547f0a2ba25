"""Series of any length, worked on in chunks.

A series (the rows of one key) is cut by time.  Rows are dealt by (key, chunk),
never by key alone, so a long or fine series is spread over tasks.  What a chunk
has to know of the others comes from a small table with one row per (key,
chunk): edge values, counts, moments.  A window over that table carries them
along the series, and they are joined back to the chunk's rows.

Row-based windows (lags, rolling statistics, sequences) need the neighbours of a
chunk's first and last rows.  For these, rows are numbered through the series
(counts before the chunk + place in the chunk), cut into blocks of equal row
numbers, and as many rows as a window reaches are copied into the next block.

The hidden columns ``KEY`` (a struct, never null, so null keys are a series like
any other) and ``CHUNK`` pass from step to step, which keeps the partitioning;
:func:`plain` drops them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..util import epoch_seconds, interval_seconds, quote

KEY, CHUNK, POS, SIZE, BLOCK, OWN = "_key", "_chunk", "_pos", "_size", "_block", "_own"
#: 2,880 bins of 15 minutes.
CHUNK_WIDTH = "30d"
BLOCK_ROWS = 4096
HIDDEN = (KEY, CHUNK, POS, SIZE, BLOCK, OWN)

#: ``OVER`` texts: a chunk, a chunk's rows up to the current one, from its end back to it.
IN_CHUNK = f"OVER (PARTITION BY {KEY}, {CHUNK}"
IN_BLOCK = f"OVER (PARTITION BY {KEY}, {BLOCK} ORDER BY {POS}"


def so_far(ts: str, desc: bool = False) -> str:
    return f"{IN_CHUNK} ORDER BY {quote(ts)} {'DESC' if desc else 'ASC'} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df if KEY in df.columns else df.withColumn(KEY, F.struct(*keys))


def chunked(df: DataFrame, keys: Sequence[str], ts: str, width: str | int = CHUNK_WIDTH) -> DataFrame:
    """Adds ``KEY`` and ``CHUNK`` (its number since the epoch), if not there yet."""
    if CHUNK in df.columns:
        return df
    return keyed(df, keys).withColumn(CHUNK, F.floor(epoch_seconds(F.col(ts)) / F.lit(interval_seconds(width))))


def plain(df: DataFrame) -> DataFrame:
    return df.drop(*(c for c in HIDDEN if c in df.columns))


def like(df: DataFrame, result: DataFrame) -> DataFrame:
    """``result`` with the hidden columns only if ``df`` had them."""
    return result if CHUNK in df.columns else plain(result)


def per_chunk(rows: DataFrame, aggregates: dict[str, Column]) -> DataFrame:
    """The small table: one row per (key, chunk)."""
    return rows.groupBy(KEY, CHUNK).agg(*(c.alias(n) for n, c in aggregates.items()))


def along(desc: bool = False):
    """Window over the small table: the chunks of a series in order."""
    return Window.partitionBy(KEY).orderBy(F.col(CHUNK).desc() if desc else F.col(CHUNK).asc())


def earlier(c: Column) -> Column:
    """Last non-null value of ``c`` in the chunks before."""
    return F.last(c, True).over(along().rowsBetween(Window.unboundedPreceding, -1))


def later(c: Column) -> Column:
    """First non-null value of ``c`` in the chunks behind."""
    return F.last(c, True).over(along(desc=True).rowsBetween(Window.unboundedPreceding, -1))


def over_series(c: Column) -> Column:
    """Aggregate ``c`` over all chunks of the series."""
    return c.over(Window.partitionBy(KEY))


def first_of_series(c: Column) -> Column:
    return F.first(c, True).over(along().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))


def last_of_series(c: Column) -> Column:
    return F.last(c, True).over(along().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))


def join_facts(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Facts of its chunk on every row.  Spark broadcasts the small table where
    its measured size allows; else rows meet it by (key, chunk)."""
    return rows.join(facts, [KEY, CHUNK], "left")


def numbered(df: DataFrame, keys: Sequence[str], ts: str, width: str | int = CHUNK_WIDTH) -> DataFrame:
    """Adds ``POS`` (place in the series by ``ts``, from 0) and ``SIZE`` (rows of
    the series)."""
    rows = chunked(df, keys, ts, width)
    counts = per_chunk(rows, {"_n": F.count(F.lit(1))})
    before = F.coalesce(F.sum("_n").over(along().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    facts = counts.select(KEY, CHUNK, before.alias("_before"), over_series(F.sum("_n")).alias(SIZE))
    place = F.expr(f"row_number() {IN_CHUNK} ORDER BY {quote(ts)})")
    return join_facts(rows, facts).withColumn(POS, F.col("_before") + place - 1).drop("_before")


def with_borders(df: DataFrame, keys: Sequence[str], ts: str, before: int, after: int,
                 width: str | int = CHUNK_WIDTH, rows: int = BLOCK_ROWS) -> DataFrame:
    """Adds ``BLOCK`` and ``OWN``: rows in blocks of ``rows`` (at least what a
    window reaches) by place, the last ``before`` rows of a block copied into the
    next one, the first ``after`` into the one before; copies are not ``OWN``."""
    size = max(rows, before, after, 1)
    placed = numbered(df, keys, ts, width)
    home, at = F.expr(f"{POS} div {size}"), F.col(POS) % size
    targets = F.array(home, F.when(at >= size - before, home + 1) if before else F.lit(None).cast("long"),
                      F.when((at < after) & (home > 0), home - 1) if after else F.lit(None).cast("long"))
    spread = placed.withColumn(BLOCK, F.explode(F.array_compact(targets)))
    return spread.withColumn(OWN, F.col(BLOCK) == F.expr(f"{POS} div {size}"))


def windowed(df: DataFrame, columns: Callable[[], dict[str, Column]], keys: Sequence[str], ts: str, before: int, after: int,
             width: str | int = CHUNK_WIDTH) -> DataFrame:
    """Adds ``columns`` (windows ``IN_BLOCK``) to the rows of ``df``, with its
    blocks as the chunks of what follows."""
    spread = with_borders(df, keys, ts, before, after, width)
    made = spread.withColumns(columns()).where(OWN)
    return made.drop(POS, SIZE, OWN, CHUNK).withColumnRenamed(BLOCK, CHUNK)
