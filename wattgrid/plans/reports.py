"""Report tables over a schedule.

``schedule`` is the long table of ``optimize_schedules`` (one row per
appliance and hour with ``price``, ``kw``, ``baseline_on`` and ``is_on``).
All reports are group-bys or pivots with explicit value lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import RESULT_METRICS, SCHEDULE_WIDE_LABELS, SUMMARY_LABELS
from ..functions.formatting import clock_label, money

HOURS = list(range(24))


def appliance_costs(schedule: DataFrame, keys: Sequence[str] = ("home_id",)) -> DataFrame:
    """A11 twice: cost, first ON hour and last ON hour + 1, baseline and optimised."""
    cost = F.col("kw") * F.col("price")

    def first(flag):
        return F.min(F.when(F.col(flag) == 1, F.col("hour")))

    def end(flag):
        return F.max(F.when(F.col(flag) == 1, F.col("hour"))) + 1

    return schedule.groupBy(*keys, "appliance").agg(
        F.first("power_rating").alias("power_w"), F.first("runtime_hours").alias("runtime_h"),
        first("baseline_on").alias("original_start"), end("baseline_on").alias("original_end"),
        first("is_on").alias("optimized_start"), end("is_on").alias("optimized_end"),
        F.sum(F.col("baseline_on") * cost).alias("original_cost"),
        F.sum(F.col("is_on") * cost).alias("optimized_cost"))


def schedule_summary(schedule: DataFrame, keys: Sequence[str] = ("home_id",), *,
                     labels: bool = False) -> DataFrame:
    """R2: hours as ``HH:00`` (``N/A`` if never ON), money as ``%.4f``.
    ``Runtime (h)`` is the configured runtime, not the rounded-up hours."""
    a = appliance_costs(schedule, keys)
    out = a.select(*keys, "appliance", "power_w", "runtime_h",
                   *[clock_label(F.col(c)).alias(c) for c in
                     ("original_start", "original_end", "optimized_start", "optimized_end")],
                   money(F.col("original_cost")).alias("original_cost"),
                   money(F.col("optimized_cost")).alias("optimized_cost"),
                   money(F.col("original_cost") - F.col("optimized_cost")).alias("savings"))
    if labels:
        out = out.withColumnsRenamed(SUMMARY_LABELS)
    return out


def hourly_power_cost(schedule: DataFrame, keys: Sequence[str] = ("home_id",)) -> DataFrame:
    """Per hour, kW and cost of the baseline and the optimised plan."""
    kw_o = F.col("baseline_on") * F.col("kw")
    kw_n = F.col("is_on") * F.col("kw")
    return schedule.groupBy(*keys, "hour").agg(
        F.sum(kw_o).alias("original_kw"), F.sum(kw_n).alias("optimized_kw"),
        F.sum(kw_o * F.col("price")).alias("original_cost"), F.sum(kw_n * F.col("price")).alias("optimized_cost"))


def appliances_per_hour(schedule: DataFrame, keys: Sequence[str] = ("home_id",), flag: str = "is_on") -> DataFrame:
    """Running appliances per hour."""
    return schedule.groupBy(*keys, "hour").agg(F.sum(flag).alias("n_on"))


def savings_and_peak(schedule: DataFrame, keys: Sequence[str] = ("home_id",)) -> DataFrame:
    """A9, A10, A14, A15 per home.  Peak-to-average counts appliances (not
    watts): max over hours / mean over hours with any; 0 if none."""
    cost = F.col("kw") * F.col("price")
    hourly = schedule.groupBy(*keys, "hour").agg(
        F.sum("baseline_on").alias("n_o"), F.sum("is_on").alias("n_n"),
        F.sum(F.col("baseline_on") * cost).alias("c_o"), F.sum(F.col("is_on") * cost).alias("c_n"))

    def par(n):
        avg_pos = F.avg(F.when(F.col(n) > 0, F.col(n)))
        return F.coalesce(F.try_divide(F.max(n).cast("double"), avg_pos), F.lit(0.0))

    agg = hourly.groupBy(*keys).agg(
        F.sum("c_o").alias("original_cost"), F.sum("c_n").alias("optimized_cost"),
        par("n_o").alias("original_peak_to_avg"), par("n_n").alias("optimized_peak_to_avg"))
    saved = F.col("original_cost") - F.col("optimized_cost")
    return agg.select(*keys, "original_cost", "optimized_cost", saved.alias("absolute_savings"),
                      F.when(F.col("original_cost") > 0, saved / F.col("original_cost") * 100)
                      .otherwise(F.lit(0.0)).alias("percent_savings"),
                      "original_peak_to_avg", "optimized_peak_to_avg")


def savings_metrics(original_cost, optimized_cost):
    """A15 as columns: absolute and percent savings (0 if original <= 0)."""
    saved = original_cost - optimized_cost
    return {"absolute_savings": saved,
            "percent_savings": F.when(original_cost > 0, saved / original_cost * 100).otherwise(F.lit(0.0))}


def schedule_matrix(schedule: DataFrame, keys: Sequence[str] = ("home_id",), flag: str = "is_on") -> DataFrame:
    """One row per appliance, one column per hour (``h00`` .. ``h23``)."""
    return (schedule.groupBy(*keys, "appliance").pivot("hour", HOURS).agg(F.max(flag))
            .withColumnsRenamed({str(h): f"h{h:02d}" for h in HOURS}))


def schedule_wide(schedule: DataFrame, values: Sequence, *, pivot_col: str = "appliance",
                  keys: Sequence[str] = ("home_id",), flag: str = "is_on", names: Sequence[str] | None = None,
                  labels: bool = False) -> DataFrame:
    """``hour, price`` and one ON/OFF column per appliance (explicit list)."""
    out = schedule.groupBy(*keys, "hour", "price").pivot(pivot_col, list(values)).agg(F.max(flag))
    if names:
        out = out.withColumnsRenamed({str(v): n for v, n in zip(values, names)})
    if labels:
        out = out.withColumnsRenamed(SCHEDULE_WIDE_LABELS)
    return out


def results_summary(metrics: DataFrame, savings: DataFrame) -> DataFrame:
    """``(position, Metric, Value)`` rows from a one-row metrics
    frame (rmse, mae, mape) and a one-row savings frame; an absent metric
    reads 0.  One pass over each input (an exploded array of structs)."""
    parts = []
    for src, names in ((metrics, ("rmse", "mae", "mape")),
                       (savings, ("original_cost", "optimized_cost", "absolute_savings", "percent_savings"))):
        items = []
        for i, (label, col, fmt) in enumerate(RESULT_METRICS):
            if col not in names:
                continue
            val = F.col(col).cast("double") if col in src.columns else F.lit(0.0)
            items.append(F.struct(F.lit(i).alias("position"), F.lit(label).alias("Metric"),
                                  F.format_string(fmt, F.coalesce(val, F.lit(0.0))).alias("Value")))
        parts.append(src.select(F.explode(F.array(*items)).alias("r")).select("r.*"))
    return parts[0].unionByName(parts[1])
