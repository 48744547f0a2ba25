"""Meter readings sources."""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from ..constants import (COMBINED_DIR, COMBINED_FILE, LONG_ID_COL, LONG_TIME_COL, LONG_VALUE_COL,
                         VARIABLE_CHANNELS, VARIABLE_ID_PATTERN, WIDE_FILE_TEMPLATE)
from ..util import nan_to_null

def _join(*parts: str) -> str:
    return "/".join(p.rstrip("/") for p in parts)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("text").load(path).schema  # noqa: B018 - file listing only
        return True
    except AnalysisException:
        return False


def _path(uri: str) -> str:
    """A file's address as Spark reports it, made comparable."""
    return re.sub(r"^file:/+", "file:/", unquote(uri))


HEADER_LINES = 20
#: Files whose first lines are looked at side by side.
HEADER_FILES = 8


def header_lines(spark: SparkSession, file: str, lines: int = HEADER_LINES) -> list[str]:
    """The first lines of a file, in their order.

    They come from the file's first block only: a limit over all blocks of a
    large file keeps the lines of whichever task ends first.  The scan stops
    after these lines, so what is read follows the number of files, not their
    size."""
    rows = spark.read.text(unquote(file)).where(F.col("_metadata.file_block_start") == 0).select("value")
    return [r["value"] for r in rows.head(lines)]


def headers(spark: SparkSession, paths: Sequence[str] | str, time_col: str) -> dict[tuple[str, ...], list[str]]:
    """Column names -> the CSV files that have them in that order.

    A header is the first of a file's first lines that names ``time_col``; one
    line per file comes back.  A file without one raises."""
    files = sorted(spark.read.text(paths).inputFiles())
    named = re.compile(rf'(^|,)\s*"?{re.escape(time_col)}"?\s*(,|$)')
    out: dict[tuple[str, ...], list[str]] = {}
    found = set()
    with ThreadPoolExecutor(HEADER_FILES) as pool:
        firsts = list(pool.map(lambda f: header_lines(spark, f), files))
    for file, first in zip(files, firsts, strict=True):
        header = next((line for line in first if named.search(line)), None)
        if header is not None:
            columns = tuple(c.strip().lstrip("\ufeff") for c in next(csv.reader([header])))
            out.setdefault(columns, []).append(_path(file))
            found.add(file)
    bare = [_path(f) for f in files if f not in found]
    if bare:
        raise ValueError(f"no column {time_col!r} in {bare}")
    return out


def read_csv_by_name(spark: SparkSession, paths: Sequence[str] | str, time_col: str,
                     kinds: Callable[[str], DataType]) -> DataFrame:
    """All files, whatever the order of their columns: files with the same
    header are one scan with an explicit schema (``kinds`` gives a column's
    type), the scans are put together by column name; a column that a file
    lacks is NULL there.  ``_file`` is the file's path."""
    parts = []
    for columns, files in headers(spark, paths, time_col).items():
        schema = StructType([StructField(c, kinds(c), True) for c in columns])
        parts.append(spark.read.schema(schema).option("header", True).csv(files)
                     .select("*", F.col("_metadata.file_path").alias("_file")))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def channel_dimension(spark: SparkSession, mapping: dict | None = None, home_id: int = 1) -> DataFrame:
    """``(variable_id, home_id, channel)``; the known mapping is one home's."""
    mapping = mapping or VARIABLE_CHANNELS
    rows = [(k, int(home_id), v) for k, v in mapping.items()]
    return spark.createDataFrame(rows, "variable_id string, home_id bigint, channel string")


def _checked(raw: DataFrame, time_col: str, value_cols: Sequence[str]) -> DataFrame:
    """Adds ``_ts`` and ``_reason``: what makes a line unreadable (NULL: it
    is fine).  An empty value is a missing one, not a bad one."""
    bad = F.lit(False)
    for c in value_cols:
        bad = bad | (F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast("double").isNull())
    ts = F.col(f"`{time_col}`").try_cast("timestamp_ntz")
    return raw.withColumn("_ts", ts).withColumn("_reason", F.when(F.col("_ts").isNull(), "time not readable")
                                                .when(bad, "value not readable"))


def _texts(spark: SparkSession, path: Sequence[str] | str, time_col: str) -> tuple[DataFrame, list[str]]:
    """All columns as text, and the names of those that are values."""
    raw = read_csv_by_name(spark, path, time_col, lambda c: StringType())
    return raw, [c for c in raw.columns if c not in (time_col, LONG_ID_COL, "_file")]


def rejected_lines(spark: SparkSession, path: Sequence[str] | str, time_col: str = LONG_TIME_COL) -> DataFrame:
    """``(file, reason, line)`` of the lines that the readers leave out, the
    line as JSON: of the combined file, or of wide files with their
    ``time_col``.  Lines are never dropped without being here."""
    raw, values = _texts(spark, path, time_col)
    values = [LONG_VALUE_COL] if LONG_VALUE_COL in values and LONG_ID_COL in raw.columns else values
    line = F.to_json(F.struct(*(F.col(f"`{c}`") for c in raw.columns if c != "_file")))
    return _checked(raw, time_col, values).where("_reason is not null").select(
        F.col("_file").alias("file"), F.col("_reason").alias("reason"), line.alias("line"))


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Rejected lines per file and reason."""
    return rejects.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("n_lines"))


def read_combined_csv(spark: SparkSession, path: Sequence[str] | str) -> DataFrame:
    """The combined long CSV, columns by name; NaN becomes NULL.  Lines
    that cannot be read are left to :func:`rejected_lines`."""
    raw, values = _texts(spark, path, LONG_TIME_COL)
    return _checked(raw, LONG_TIME_COL, [c for c in values if c == LONG_VALUE_COL]).where("_reason is null").select(
        F.col(f"`{LONG_ID_COL}`").alias("variable_id"), F.col("_ts").alias("ts"),
        nan_to_null(F.col(LONG_VALUE_COL).cast("double")).alias("watts"), F.monotonically_increasing_id().alias("seq"))


def filter_variables(df: DataFrame, pattern: str = VARIABLE_ID_PATTERN, id_col: str = "variable_id",
                     ids: Sequence[str] | None = None) -> DataFrame:
    """Keep ids matching the pattern (searched anywhere, as the reference).

    With ``ids`` (a known, small id list) an ``isin`` pre-filter is added:
    it reaches the file scan as a pushed filter, ``rlike`` does not."""
    cond = F.col(id_col).rlike(pattern)
    if ids is not None:
        cond = F.col(id_col).isin(list(ids)) & cond
    return df.filter(cond)


def rename_channels(df: DataFrame, dimension: DataFrame, id_col: str = "variable_id") -> DataFrame:
    """Attach (home_id, channel) from the dimension; ids it lacks drop out.

    The dimension holds one row per metered channel (small); AQE broadcasts it
    at runtime when its measured size is under the broadcast threshold."""
    return df.join(dimension.withColumnRenamed("variable_id", id_col), id_col)


def read_wide_csv(spark: SparkSession, path: Sequence[str] | str, channels: Sequence[str] | None = None, *,
                  time_col: str = "timestamp", home_id: int | None = None) -> DataFrame:
    """S3: wide per-home CSV(s) -> ``(home_id, ts, <channel> double ...)``.

    ``home_id`` comes from the file name (``CLEAN_House<N>.csv``) unless given,
    so a list or glob over many homes reads together; their columns may differ
    in order and number.  Lines that cannot be read are left to
    :func:`rejected_lines`."""
    raw, present = _texts(spark, path, time_col)
    cols = present if channels is None else [c for c in channels if c in present]
    hid = (F.lit(int(home_id)).cast("long") if home_id is not None else
           F.regexp_extract("_file", r"House(\d+)", 1).cast("long"))
    return _checked(raw, time_col, present).where("_reason is null").select(
        hid.alias("home_id"), F.col("_ts").alias("ts"), *[nan_to_null(F.col(f"`{c}`").cast("double")).alias(c) for c in cols])


def select_channels(df: DataFrame, channels: Sequence[str], keys=("home_id",), ts="ts") -> DataFrame:
    """Keep the requested channels that exist; error if none does."""
    available = [c for c in channels if c in df.columns]
    if not available:
        raise ValueError(f"no column among {list(channels)}; the frame has {df.columns}")
    return df.select(*keys, ts, *available)


def load_readings(spark: SparkSession, data_path: str, home_id: int | Sequence[int] = 1,
                  dimension: DataFrame | None = None) -> DataFrame:
    """For each home its wide file, in ``data_path`` or its combined-file
    folder; for the others the combined long file, joined with the dimension
    (P2), which also says which ids are kept, and pivoted (A1).  Without a
    ``dimension`` the known ids (P1) are home 1's.  A home that the dimension
    does not have raises; so does a missing input (S4)."""
    from ..operators.pivot import pivot_first

    homes = [home_id] if isinstance(home_id, int) else list(home_id)
    combined = _join(data_path, COMBINED_DIR, COMBINED_FILE)
    tried, wide, rest = [], [], []
    for home in homes:
        name = WIDE_FILE_TEMPLATE.format(home_id=home)
        places = [_join(data_path, name), _join(data_path, COMBINED_DIR, name)]
        at = next((p for p in places if _exists(spark, p)), None)
        if at is None:
            rest.append(home)
            tried += places
        else:
            wide.append(at)
    frames = [read_wide_csv(spark, wide)] if wide else []
    if rest:
        if not _exists(spark, combined):
            raise FileNotFoundError(f"no readings of homes {rest}: none of these exists: {[*tried, combined]}")
        dim = channel_dimension(spark) if dimension is None else dimension
        dim = dim.where(F.col("home_id").isin(rest))
        # Pivot columns: one row per home and channel asked for, ordered by id
        # text (D3): Aggregate, Appliance9, Appliance1, ...
        names = dim.groupBy("channel").agg(F.min("variable_id").alias("first_id"),
                                           F.collect_set("home_id").alias("homes")).collect()
        unknown = sorted(set(rest) - {h for r in names for h in r["homes"]})
        if unknown:
            raise ValueError(f"no channels known for homes {unknown}; pass a dimension that has them")
        long = read_combined_csv(spark, combined)
        if dimension is None:
            long = filter_variables(long, ids=list(VARIABLE_CHANNELS))
        channels = [r["channel"] for r in sorted(names, key=lambda r: r["first_id"])]
        frames.append(pivot_first(rename_channels(long, dim), channels))
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)


def load_and_prepare(spark: SparkSession, data_path: str, home_id: int | Sequence[int] = 1,
                     weather_path: str | None = None, appliance_subset: Sequence[str] | None = None, *,
                     tolerance: str = "1h", dimension: DataFrame | None = None, salt: int | None = None) -> DataFrame:
    """Readings of one or more homes (S1) + optional weather (S5) by
    nearest time (J1/J2) + optional channel subset (P3), lazily."""
    from ..operators.asof import merge_weather
    from .weather import load_weather

    readings = load_readings(spark, data_path, home_id, dimension)
    weather = load_weather(spark, weather_path) if weather_path else None
    df = merge_weather(readings, weather, tolerance=tolerance, salt=salt)
    return select_channels(df, appliance_subset) if appliance_subset else df
