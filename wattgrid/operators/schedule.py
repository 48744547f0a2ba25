"""Cost-minimal appliance schedules for
many homes at once.

Inputs are tables:
* appliances ``(keys..., appliance, runtime_hours, earliest_start,
  latest_finish, power_rating)`` (W; window ``[earliest, latest)``);
* tariffs ``(tariff_id, hour, price)``, 24 rows each;
* plans ``(keys..., tariff_id, allow_simultaneous, max_simultaneous)``.

Plan: each tariff becomes one row with its 24 prices and its hours from the
cheapest to the dearest.  An appliance's ``ceil(runtime)`` cheapest allowed
hours are a filter and a slice of that array: one row per appliance, no
window, no grid.  One aggregate per home counts the appliances per hour; homes
where the cap never binds are optimal as they are, the others go through an
exact min-cost flow (``mapInPandas`` over home-sorted partitions, one whole
home at a time).  A home that needs more than ``24 * cap`` appliance-hours is
infeasible without solving.  The 24-hour grid is only made for reports.

Ties: among equal-cost schedules the chosen one is canonical - cost first,
then the set of (appliance ordinal, hour) cells read as a binary number,
smallest first (appliances ordered by name).  The cheapest-hours ranking
picks exactly that schedule where the cap does not bind, so both paths agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .flow import assignment_with_prices

HOURS = 24
COST_SCALE = 1_000_000  # integer cost units = W * price * 1e6 (GBP * 1e9)
REQUIRED = ["runtime_hours", "earliest_start", "latest_finish", "power_rating"]


# --- F13 / F14 -------------------------------------------------------------

def validate_appliances(appliances: DataFrame, *, keys: Sequence[str] = ("home_id",),
                        strict: bool = False) -> DataFrame:
    """Add ``violation`` (NULL when valid): a missing value, an hour out of
    range, a runtime that is not positive or does not fit the window, a power
    that is negative or no number, or a name that the home uses twice."""
    es, lf, rt = F.col("earliest_start"), F.col("latest_finish"), F.col("runtime_hours")
    power = F.col("power_rating").cast("double")
    v = None
    for key in REQUIRED:
        cond, msg = F.col(key).isNull(), F.lit(f"{key} has no value")
        v = F.when(cond, msg) if v is None else v.when(cond, msg)
    twice = F.count(F.lit(1)).over(Window.partitionBy(*keys, "appliance")) > 1
    v = (v.when((es < 0) | (es >= HOURS), F.lit("start hour not within the day"))
         .when((lf <= 0) | (lf > HOURS), F.lit("finish hour not within the day"))
         .when(rt <= 0, F.lit("runtime not positive"))
         .when(es + rt > lf, F.lit("runtime longer than the window"))
         .when((power < 0) | F.isnan(power) | (power == float("inf")), F.lit("power not finite or negative"))
         .when(twice, F.lit("name used twice in the home")))
    out = appliances.withColumn("violation", v)
    if strict:
        bad = out.filter(F.col("violation").isNotNull()).select("appliance", "violation").limit(1).collect()
        if bad:
            raise ValueError(f"{bad[0]['appliance']}: {bad[0]['violation']}")
    return out


def validate_tariffs(tariffs: DataFrame) -> DataFrame:
    """One row per tariff: exactly 24 rows, one per hour 0..23, each with a
    finite price."""
    price = F.col("price").cast("double")
    finite = price.isNotNull() & ~F.isnan(price) & (F.abs(price) < float("inf"))
    return (tariffs.groupBy("tariff_id")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("hour").alias("n_hours"),
                 F.min("hour").alias("min_hour"), F.max("hour").alias("max_hour"),
                 F.sum(finite.cast("long")).alias("n_priced"))
            .withColumn("valid", (F.col("n_rows") == HOURS) & (F.col("n_hours") == HOURS) & (F.col("n_priced") == HOURS)
                        & (F.col("min_hour") == 0) & (F.col("max_hour") == HOURS - 1)))


# --- homes, appliance rows, baseline, cheapest hours -----------------------

def effective_cap(plans: DataFrame) -> DataFrame:
    return plans.withColumn(
        "cap", F.when(F.coalesce(F.col("allow_simultaneous"), F.lit(True)), F.col("max_simultaneous"))
        .otherwise(F.lit(1)).cast("int"))


def home_checks(checked: DataFrame, plans: DataFrame, tariff_status: DataFrame,
                keys: Sequence[str] = ("home_id",)) -> DataFrame:
    """One row per home that has a plan or an appliance: cap, appliance count,
    demand; ``valid_home`` is false when the plan or the appliances are absent,
    when there are several plans or the plan has no cap, or when any appliance
    or the tariff fails validation; ``solvable`` also needs the demand to fit
    ``24 * cap`` (else infeasible without solving)."""
    per_home = checked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_appliances"),
        F.sum(F.col("violation").isNotNull().cast("int")).alias("n_invalid"),
        F.sum(F.when(F.col("violation").isNull(), F.ceil("runtime_hours"))).alias("total_need"))
    one_plan = effective_cap(plans).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_plans"), F.min("tariff_id").alias("tariff_id"), F.min("cap").alias("cap"))
    tv = tariff_status.select("tariff_id", F.col("valid").alias("tariff_valid"))
    p = (one_plan.withColumn("has_plan", F.lit(True))
         .join(per_home, list(keys), "full").join(tv, "tariff_id", "left"))
    no = F.lit(False)
    valid = (F.coalesce(F.col("has_plan"), no) & F.coalesce(F.col("n_invalid") == 0, no)
             & F.coalesce(F.col("n_plans") == 1, no) & F.col("cap").isNotNull() & F.coalesce(F.col("tariff_valid"), no))
    return p.withColumns({"has_plan": F.coalesce(F.col("has_plan"), no), "valid_home": valid,
                          "solvable": valid & (F.col("total_need") <= HOURS * F.col("cap"))})


def tariff_rows(tariffs: DataFrame, tariff_status: DataFrame) -> DataFrame:
    """One row per valid tariff: ``prices`` by hour, and the hours ``ranked``
    from the cheapest to the dearest (ties: the earlier)."""
    ok = tariff_status.filter("valid").select("tariff_id")
    pair = F.struct(F.col("price").cast("double").alias("price"), F.col("hour").cast("int").alias("hour"))
    turned = F.struct(F.col("hour").cast("int").alias("hour"), F.col("price").cast("double").alias("price"))
    return (tariffs.join(ok, "tariff_id", "left_semi").groupBy("tariff_id")
            .agg(F.array_sort(F.collect_list(turned))["price"].alias("prices"),
                 F.array_sort(F.collect_list(pair))["hour"].alias("ranked")))


def appliance_rows(checked: DataFrame, homes: DataFrame, tariffs: DataFrame,
                   keys: Sequence[str] = ("home_id",)) -> DataFrame:
    """One row per appliance of a valid home, with the prices of its tariff,
    ``need`` hours, the ``allowed`` hours from the cheapest on, the ``chosen``
    first ``need`` of them (T3) and the baseline hours (W11: ON from
    ``earliest`` for ``ceil(runtime)`` hours)."""
    h = homes.filter("valid_home").select(*keys, "tariff_id", "cap", "solvable")
    std = {*keys, "appliance", "tariff_id", "cap", "violation", *REQUIRED}
    extra = [c for c in checked.columns if c not in std]
    apps = checked.join(h, list(keys)).select(
        *keys, "appliance", *extra, "tariff_id", "cap", "solvable", F.ceil("runtime_hours").cast("int").alias("need"),
        F.col("power_rating").cast("double").alias("power_rating"),
        (F.col("power_rating") / 1000.0).alias("kw"),
        F.col("earliest_start").cast("double").alias("earliest_start"),
        F.col("latest_finish").cast("double").alias("latest_finish"),
        F.col("runtime_hours").cast("double").alias("runtime_hours"))
    es, lf = F.col("earliest_start"), F.col("latest_finish")
    day = F.sequence(F.lit(0), F.lit(HOURS - 1))
    return (apps.join(tariffs, "tariff_id")
            .withColumn("allowed", F.filter("ranked", lambda hour: (hour >= es) & (hour < lf)))
            .withColumn("chosen", F.slice("allowed", F.lit(1), F.col("need")))
            .withColumn("baseline", F.filter(day, lambda hour: (hour >= es) & (hour < es + F.col("need"))))
            .drop("ranked"))


def hour_rows(apps: DataFrame) -> DataFrame:
    """The 24-hour grid of appliance rows: price, window, baseline, ON flag."""
    hour = F.col("hour")
    return (apps.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(HOURS - 1))))
            .withColumns({"price": F.element_at("prices", hour + 1),
                          "in_window": (hour >= F.col("earliest_start")) & (hour < F.col("latest_finish")),
                          "baseline_on": F.array_contains("baseline", hour).cast("int"),
                          "is_on": F.array_contains("chosen", hour).cast("int")})
            .drop("prices", "allowed", "chosen", "baseline"))


def _loads(hours: str) -> list:
    """Per hour, how many appliances have it among ``hours``."""
    return [F.sum(F.array_contains(hours, F.lit(h)).cast("int")).alias(f"_h{h}") for h in range(HOURS)]


def _peak():
    return F.greatest(*[F.col(f"_h{h}") for h in range(HOURS)])


def _hours_cost(hours: str):
    total = F.aggregate(hours, F.lit(0.0), lambda t, h: t + F.element_at("prices", h + 1))
    return F.col("kw") * total


def _units(hour):
    """Cost of an hour of an appliance in whole units."""
    return F.round(F.col("power_rating") * F.element_at("prices", hour + 1) * F.lit(float(COST_SCALE))).cast("long")


def certify(apps: DataFrame, keys: Sequence[str] = ("home_id",)) -> DataFrame:
    """A proof for each home, from appliance rows with ``chosen`` hours
    and the home's ``hour_prices`` (units, what a place in a full hour is worth).

    ``feasible``: every appliance has ``need`` different hours of its window and
    no hour more than ``cap`` appliances.  ``slack``: only full hours have a
    price.  ``bound``: no schedule costs less than this, as every appliance needs
    at least its ``need`` cheapest hours at cost plus price, and all places of the
    day together are worth ``cap`` times the prices.  ``proven``: the schedule is
    feasible and costs no more than the bound."""
    priced = F.transform("allowed", lambda h: _units(h) + F.element_at("hour_prices", h + 1))
    zero = F.lit(0).cast("long")
    rows = apps.withColumns({
        "_cost": F.aggregate("chosen", zero, lambda t, h: t + _units(h)),
        "_least": F.aggregate(F.slice(F.array_sort(priced), F.lit(1), F.col("need")), zero, lambda t, x: t + x),
        "_ok": (F.size(F.array_distinct("chosen")) == F.col("need")) & (F.size("chosen") == F.col("need"))
        & (F.size(F.array_except("chosen", "allowed")) == 0)})
    homes = rows.groupBy(*keys).agg(
        F.first("cap").alias("cap"), F.count(F.lit(1)).alias("n_appliances"), F.sum("_cost").alias("cost"),
        F.sum("_least").alias("_least"), F.min("_ok").alias("_ok"), F.min("hour_prices").alias("_at"),
        F.max("hour_prices").alias("_at2"), *_loads("chosen"))
    loads = F.array(*(F.col(f"_h{h}") for h in range(HOURS)))
    bound = F.col("_least") - F.col("cap") * F.aggregate("_at", zero, lambda t, x: t + x)
    feasible = F.col("_ok") & F.forall(loads, lambda n: n <= F.col("cap"))
    slack = (F.col("_at") == F.col("_at2")) & F.forall(
        F.zip_with("_at", loads, lambda p, n: (p >= 0) & ((p == 0) | (n == F.col("cap")))), lambda x: x)
    return homes.select(*keys, "cap", "n_appliances", "cost", bound.alias("bound"), feasible.alias("feasible"),
                        slack.alias("slack"), (feasible & slack & (F.col("cost") <= bound)).alias("proven"),
                        F.col("_at").alias("hour_prices"))


# --- O3: exact flow for homes where the cap binds -------------------------

def _solve_home(app, allowed, cost, need, cap) -> tuple[list[list[int]], list[int] | None]:
    """Chosen hours per appliance row of one home and its hour prices (None:
    there is no schedule)."""
    rank = sorted(range(len(app)), key=lambda r: app[r])
    cells = [(i, int(h), int(c)) for i, r in enumerate(rank) for h, c in zip(allowed[r], cost[r])]
    solved = assignment_with_prices([int(need[r]) for r in rank], cells, int(cap), HOURS)
    hours: list[list[int]] = [[] for _ in app]
    if solved is None:
        return hours, None
    for i, h in solved[0]:
        hours[rank[i]].append(h)
    return hours, solved[1]


def _batch_solver(keys: Sequence[str], columns: list[str]):
    """``mapInPandas`` body: rows arrive hash-partitioned and sorted by home,
    so each home is a contiguous run; a home cut by a batch boundary is
    carried into the next batch, so every home is solved whole."""
    keys = list(keys)

    def solve_frame(pdf: pd.DataFrame) -> pd.DataFrame:
        gid = pdf.groupby(keys, sort=False).ngroup().to_numpy()
        starts = np.flatnonzero(np.r_[True, gid[1:] != gid[:-1]])
        ends = np.r_[starts[1:], len(gid)]
        app, allowed, cost = (pdf[c].to_numpy() for c in ("appliance", "allowed", "_cost"))
        need, cap = pdf["need"].to_numpy(), pdf["cap"].to_numpy()
        chosen: list = []
        hour_prices: list = []
        feasible = np.zeros(len(pdf), dtype=bool)
        for a, b in zip(starts, ends):
            hours, at = _solve_home(app[a:b], allowed[a:b], cost[a:b], need[a:b], cap[a])
            chosen += hours
            hour_prices += [at] * (b - a)
            feasible[a:b] = at is not None
        return pdf.assign(chosen=pd.Series(chosen, index=pdf.index, dtype=object), feasible=feasible,
                          hour_prices=pd.Series(hour_prices, index=pdf.index, dtype=object))[columns]

    def run(batches):
        carry = None
        for pdf in batches:
            if carry is not None:
                pdf = pd.concat([carry, pdf], ignore_index=True)
            if pdf.empty:
                continue
            last = np.logical_and.reduce([pdf[k].to_numpy() == pdf[k].iloc[-1] for k in keys])
            carry = pdf[last]
            done = pdf[~last]
            if len(done):
                yield solve_frame(done.reset_index(drop=True))
        if carry is not None and len(carry):
            yield solve_frame(carry.reset_index(drop=True))

    return run


@dataclass
class ScheduleResult:
    schedule: DataFrame  # keys, appliance, hour, price, kw, ..., baseline_on, is_on (optimal homes)
    homes: DataFrame     # keys, status, path, cap, max_on, original_cost, optimized_cost
    certificate: DataFrame  # keys, cap, n_appliances, cost, bound, feasible, slack, proven, hour_prices (optimal homes)


def optimize_schedules(appliances: DataFrame, tariffs: DataFrame, plans: DataFrame, *,
                       keys: Sequence[str] = ("home_id",), strict: bool = False,
                       checkpoint: bool = True) -> ScheduleResult:
    """O1: the schedule of every home, its status and costs.

    Every home with a plan or an appliance has a row in ``homes``; its status
    is ``no plan``, ``no appliances``, ``invalid``, ``infeasible`` or ``optimal``.
    The appliance rows are written once to the shared checkpoint folder, so the
    flow runs once and the reports read the stored table."""
    from ..session import materialize

    keys = list(keys)
    # Everything below is per home: one exchange on the home serves the
    # duplicate check, the per-home aggregates and the joins back.  The explicit
    # count keeps AQE from coalescing a CPU-bound stage by bytes.
    parts = int(appliances.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    checked = validate_appliances(appliances.repartition(parts, *keys), keys=keys, strict=strict)
    tariff_status = validate_tariffs(tariffs)
    homes = home_checks(checked, plans, tariff_status, keys)
    apps = appliance_rows(checked, homes, tariff_rows(tariffs, tariff_status), keys)
    ranked = apps.groupBy(*keys).agg(*_loads("chosen"), F.max(F.size("allowed") < F.col("need")).alias("_short"),
                                     F.first("cap").alias("_cap"), F.first("solvable").alias("_solvable"))
    paths = ranked.select(*keys, F.when(~F.col("_solvable") | F.col("_short"), F.lit("none"))
                          .when(_peak() <= F.col("_cap"), F.lit("ranked")).otherwise(F.lit("flow")).alias("path"))
    apps = apps.join(paths, keys).drop("solvable")
    none = F.array().cast("array<int>")
    direct = (apps.filter(F.col("path") != "flow")
              .withColumns({"chosen": F.when(F.col("path") == "ranked", F.col("chosen")).otherwise(none),
                            "feasible": F.col("path") == "ranked",
                            "hour_prices": F.when(F.col("path") == "ranked", F.array_repeat(F.lit(0).cast("long"), HOURS))}))
    flow_in = apps.filter(F.col("path") == "flow").withColumn("_cost", F.transform("allowed", _units))
    # mapInPandas needs every row of a home in one partition: state it (Spark
    # drops this exchange when the rows are already partitioned that way).
    flowed = (flow_in.repartition(parts, *keys).sortWithinPartitions(*keys)
              .mapInPandas(_batch_solver(keys, direct.columns), direct.schema))
    full = direct.unionByName(flowed)
    if checkpoint:
        full = materialize(full)

    per_home = full.groupBy(*keys).agg(
        *_loads("chosen"), F.sum(_hours_cost("baseline")).alias("original_cost"),
        F.sum(_hours_cost("chosen")).alias("optimized_cost"), F.min("feasible").alias("feasible"),
        F.first("path").alias("path")).withColumn("max_on", _peak())
    optimal = F.coalesce(F.col("feasible"), F.lit(False))
    status = (homes.select(*keys, "cap", "has_plan", "n_appliances", "valid_home").join(per_home, keys, "left")
              .select(*keys,
                      F.when(~F.col("has_plan"), F.lit("no plan"))
                      .when(F.col("n_appliances").isNull(), F.lit("no appliances"))
                      .when(~F.col("valid_home"), F.lit("invalid"))
                      .when(optimal, F.lit("optimal")).otherwise(F.lit("infeasible")).alias("status"),
                      F.when(optimal, F.col("path")).alias("path"), "cap",
                      F.when(optimal, F.col("max_on")).alias("max_on"),
                      "original_cost", F.when(optimal, F.col("optimized_cost")).alias("optimized_cost")))
    schedule = hour_rows(full.filter("feasible").drop("feasible", "hour_prices"))
    if strict:
        bad = status.filter(F.col("status") != "optimal").select(*keys, "status").limit(1).collect()
        if bad:
            raise RuntimeError(f"{bad[0].asDict()} has no schedule")
    return ScheduleResult(schedule=schedule, homes=status, certificate=certify(full.filter("feasible"), keys))


def _valid_rows(appliances: DataFrame, tariffs: DataFrame, plans: DataFrame, keys: Sequence[str]) -> DataFrame:
    checked = validate_appliances(appliances, keys=keys)
    ts = validate_tariffs(tariffs)
    return appliance_rows(checked, home_checks(checked, plans, ts, keys), tariff_rows(tariffs, ts), keys)


def baseline_schedule(appliances: DataFrame, tariffs: DataFrame, plans: DataFrame, *,
                      keys: Sequence[str] = ("home_id",)) -> DataFrame:
    """W11 as a long 24-hour table ``(keys, appliance, hour, is_on)``."""
    return hour_rows(_valid_rows(appliances, tariffs, plans, keys)).select(
        *keys, "appliance", "hour", F.col("baseline_on").alias("is_on"))


def baseline_costs(appliances: DataFrame, tariffs: DataFrame, plans: DataFrame, *,
                   keys: Sequence[str] = ("home_id",)) -> DataFrame:
    """A10: cost of the baseline per valid home; nothing is optimised."""
    return _valid_rows(appliances, tariffs, plans, keys).groupBy(*keys).agg(
        F.sum(_hours_cost("baseline")).alias("original_cost"))


def cheapest_hours(appliances: DataFrame, tariffs: DataFrame, plans: DataFrame, *,
                   keys: Sequence[str] = ("home_id",)) -> DataFrame:
    """T3 / O2 without a cap: the chosen ``(keys, appliance, hour)``."""
    return _valid_rows(appliances, tariffs, plans, keys).select(
        *keys, "appliance", F.explode("chosen").alias("hour"))
