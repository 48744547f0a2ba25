"""As-of join, nearest match within a tolerance, left outer.

Semantics (those of the reference's nearest as-of merge):
* the previous candidate is the last right row at or before the left time,
  the next candidate is the first right row strictly after it;
* the nearer one wins, a tie goes to the previous one;
* duplicates at the previous time -> the last of them (by ``right_order``),
  at the next time -> the first of them;
* distance must be <= tolerance (inclusive); otherwise right columns are NULL.

Plan: no pairs are ever formed.  Left and right rows are unioned and each
left row finds its neighbours with a running ``last(..., ignorenulls)`` in
time order and in reverse time order.  A window partition is a piece of time of
one key: a bucket as wide as the tolerance or, where a bucket has more rows than
``part_rows``, a part of it.  The pieces come from counts per (key, bucket,
cell), a small table: it also carries the last right row before and the first
one behind each piece, so no right row is copied into other pieces.  A cell that
alone has too many left rows is spread by a hash of the row.  Right rows of one
key and time are made one beforehand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..util import interval_seconds, quote

KEY = "_key"
CELLS = 64
PART_ROWS = 200_000


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def _right_times(right: DataFrame, on: str, order: Column, values: Column) -> DataFrame:
    """``(KEY, _t, _rf, _rl)``: the first and the last right row of each time."""
    rows = right.select(KEY, F.col(on).alias("_t"), order.alias("_ro"), values.alias("_r"))
    return rows.groupBy(KEY, "_t").agg(F.min_by("_r", "_ro").alias("_rf"), F.max_by("_r", "_ro").alias("_rl"))


def _pieces(left: DataFrame, right: DataFrame, part_rows: int, salt: int) -> DataFrame:
    """The small table: ``(KEY, _b, _p, _from, _salts, _prev, _next)``, one row per
    piece of a bucket ``_b``: the cell it starts with, over how many parts its
    left rows are spread, the last right row before it and the first behind it."""
    none = F.lit(None)
    rows = left.select(KEY, "_b", "_c", F.lit(1).alias("_l"), none.cast("timestamp_ntz").alias("_t"),
                       *(none.cast(right.schema[c].dataType).alias(c) for c in ("_rf", "_rl")))
    rows = rows.unionByName(right.select(KEY, "_b", "_c", F.lit(0).alias("_l"), "_t", "_rf", "_rl"))
    edges = [F.min("_t").alias("_ft"), F.min_by("_rf", "_t").alias("_rf"), F.max("_t").alias("_lt"), F.max_by("_rl", "_t").alias("_rl")]
    cells = rows.groupBy(KEY, "_b", "_c").agg(F.count("*").alias("_n"), F.sum("_l").alias("_left"), *edges)
    so_far = Window.partitionBy(KEY, "_b").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    cut = cells.withColumn("_cut", F.floor(F.coalesce(F.sum("_n").over(so_far), F.lit(0)) / F.lit(int(part_rows))))
    pieces = cut.groupBy(KEY, "_b", "_cut").agg(
        F.min("_c").alias("_from"), F.sum("_left").alias("_left"), F.min("_ft").alias("_ft"), F.min_by("_rf", "_ft").alias("_rf"),
        F.max("_lt").alias("_lt"), F.max_by("_rl", "_lt").alias("_rl"))
    order = Window.partitionBy(KEY).orderBy("_b", "_from")
    back = Window.partitionBy(KEY).orderBy(F.desc("_b"), F.desc("_from"))
    past = Window.unboundedPreceding
    last = F.when(F.col("_lt").isNotNull(), F.struct(F.col("_lt").alias("_t"), F.col("_rl").alias("_r")))
    first = F.when(F.col("_ft").isNotNull(), F.struct(F.col("_ft").alias("_t"), F.col("_rf").alias("_r")))
    return pieces.where("_from is not null").select(
        KEY, "_b", "_from", "_left",
        (F.row_number().over(Window.partitionBy(KEY, "_b").orderBy("_from")) - 1).alias("_p"),
        F.greatest(F.lit(salt), F.ceil(F.col("_left") / F.lit(int(part_rows)))).cast("int").alias("_salts"),
        F.last(last, True).over(order.rowsBetween(past, -1)).alias("_prev"),
        F.last(first, True).over(back.rowsBetween(past, -1)).alias("_next"))


def merge_nearest(left: DataFrame, right: DataFrame, *, on: str = "ts",
                  by: Sequence[str] = (), tolerance: str | int = "1h",
                  right_order: str | None = None,
                  suffixes: tuple[str, str] = ("_x", "_y"), salt: int | None = None, part_rows: int = PART_ROWS) -> DataFrame:
    """Left outer nearest as-of join of ``right`` onto ``left`` on time ``on``.

    One plan for every size.  ``part_rows``: about how many rows a window
    partition gets.  ``salt`` spreads the left rows of every piece over at least
    that many parts.

    A NULL key or time matches nothing; such left rows stay, without a match."""
    staged, l_names, r_names, right_type = _staged(left, right, on, list(by), tolerance, right_order, suffixes, salt, part_rows)
    tol_us = interval_seconds(tolerance) * 1_000_000
    part = [KEY, "_b", "_p", "_salt"]
    # Right rows sort before left rows at the same time (kind 0 < 1), so the
    # backward search includes exact matches; the search behind leaves them out.
    back = Window.partitionBy(*part).orderBy("_t", "_k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fwd = Window.partitionBy(*part).orderBy(F.desc("_t"), F.desc("_k")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prev = F.when(F.col("_rl").isNotNull(), F.struct(F.col("_t"), F.col("_rl").alias("_r")))
    after = F.when(F.col("_rf").isNotNull(), F.struct(F.col("_t"), F.col("_rf").alias("_r")))
    found = staged.select("_t", "_l", "_k", F.last(prev, True).over(back).alias("_prev"),
                          F.last(after, True).over(fwd).alias("_next")).where("_k = 1")
    now = _micros(F.col("_t"))
    dp, dn = now - _micros(F.col("_prev._t")), _micros(F.col("_next._t")) - now
    near_p = F.coalesce(dp <= tol_us, F.lit(False))
    near_n = F.coalesce((dn > 0) & (dn <= tol_us), F.lit(False))
    pick = F.when(near_p & (~near_n | (dp <= dn)), F.col("_prev._r")).when(near_n, F.col("_next._r"))
    matched = found.select("_l", pick.alias("_m"))
    # Rows that match nothing: no time, or a part of the key is missing.
    absent = left.where(" or ".join(f"{quote(c)} is null" for c in (on, *by)))
    lone = absent.select(_left_struct(left, on, by, l_names).alias("_l"), F.lit(None).cast(right_type).alias("_m"))
    out = matched.unionByName(lone)
    return out.select(*[F.col("_l")[c].alias(c) for c in (*by, on)],
                      *[F.col("_l")[n].alias(n) for n in l_names.values()],
                      *[F.col("_m")[n].alias(n) for n in r_names.values()])


def _left_struct(left: DataFrame, on: str, by: Sequence[str], names: dict[str, str]) -> Column:
    return F.struct(*(F.col(quote(c)) for c in (*by, on)), *(F.col(quote(c)).alias(n) for c, n in names.items()))


def _staged(left: DataFrame, right: DataFrame, on: str, by: list[str], tolerance, right_order, suffixes, salt, part_rows):
    """The union that the windows run over: left rows (``_k`` 1, ``_l``), right
    rows and the carried ones (``_k`` 0, ``_rf``, ``_rl``), dealt to pieces."""
    tol_us = interval_seconds(tolerance) * 1_000_000
    right_vals = [c for c in right.columns if c not in (on, *by)]
    left_vals = [c for c in left.columns if c not in (on, *by)]
    clash = set(right_vals) & set(left_vals)
    r_names = {c: (c + suffixes[1] if c in clash else c) for c in right_vals}
    l_names = {c: (c + suffixes[0] if c in clash else c) for c in left_vals}
    key = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))

    def placed(df: DataFrame) -> DataFrame:  # bucket, and cell within it
        at = _micros(F.col("_t"))
        cell = F.floor(F.pmod(at, F.lit(tol_us)) / F.lit(max(1, tol_us // CELLS)))
        return df.withColumns({"_b": F.floor(at / F.lit(tol_us)).cast("long"), "_c": cell.cast("long")})

    # The order key keeps its own type (a cast to double would lose large ids).
    order = F.col(quote(right_order)) if right_order else F.monotonically_increasing_id()
    values = F.struct(F.lit(True).alias("_row"), *[F.col(quote(c)).alias(r_names[c]) for c in right_vals])
    r = placed(_right_times(right.dropna(subset=[on, *by]).withColumn(KEY, key), on, order, values))
    lft = placed(left.dropna(subset=[on, *by]).select(
        key.alias(KEY), F.col(on).alias("_t"), _left_struct(left, on, by, l_names).alias("_l"),
        F.xxhash64(*(c.name for c in left.schema if not isinstance(c.dataType, T.MapType))).alias("_h")))
    pieces = _pieces(lft, r, part_rows, max(1, int(salt or 1)))
    # Buckets of several pieces or parts (few: each has many rows).
    cuts = (pieces.groupBy(KEY, "_b").agg(F.array_sort(F.collect_list(F.struct("_from", "_salts"))).alias("_cuts"))
            .where("size(_cuts) > 1 or _cuts[0]._salts > 1"))

    def dealt(df: DataFrame) -> DataFrame:
        joined = df.join(cuts, [KEY, "_b"], "left")
        p = F.size(F.filter("_cuts", lambda x: x["_from"] <= F.col("_c"))) - 1
        joined = joined.withColumn("_p", F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(p))
        return joined.withColumn("_salts", F.when(F.col("_cuts").isNull(), F.lit(1)).otherwise(F.col("_cuts")[F.col("_p")]["_salts"]))

    each = F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))
    where = [KEY, "_b", "_p", "_salt", "_t", "_k", "_l", "_rf", "_rl"]
    no_left = F.lit(None).cast(lft.schema["_l"].dataType)
    right_type = r.schema["_rf"].dataType
    lefts = dealt(lft).withColumns({"_salt": F.pmod("_h", "_salts").cast("int"), "_k": F.lit(1), "_rf": F.lit(None).cast(right_type),
                                    "_rl": F.lit(None).cast(right_type)}).select(where)
    rights = dealt(r).withColumn("_salt", each).withColumns({"_k": F.lit(0), "_l": no_left}).select(where)
    carried = pieces.where("_left > 0").withColumn("_salt", each)
    none = F.lit(None).cast(right_type)
    before = carried.where("_prev is not null").select(
        KEY, "_b", "_p", "_salt", F.col("_prev._t").alias("_t"), F.lit(0).alias("_k"), no_left.alias("_l"), none.alias("_rf"), F.col("_prev._r").alias("_rl"))
    behind = carried.where("_next is not null").select(
        KEY, "_b", "_p", "_salt", F.col("_next._t").alias("_t"), F.lit(0).alias("_k"), no_left.alias("_l"), F.col("_next._r").alias("_rf"), none.alias("_rl"))
    staged = lefts.unionByName(rights).unionByName(before).unionByName(behind)
    return staged, l_names, r_names, right_type


def merge_weather(readings: DataFrame, weather: DataFrame | None, **kw) -> DataFrame:
    """Pass-through when there is no weather, else J1."""
    if weather is None:
        return readings
    return merge_nearest(readings, weather, **kw)
