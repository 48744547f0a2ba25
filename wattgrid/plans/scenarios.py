"""C4: one run over a scenario table instead of one call per scenario."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import POOL_PUMP

# (scenario_id, tariff_id, allow_simultaneous, max_simultaneous): the
# reference's example scenarios that apply to any appliance set.
SCENARIOS = [
    ("basic", "default", True, 2),
    ("no_simultaneous", "default", False, 1),
    ("flat_rate", "flat", True, 2),
    ("steep_rate", "steep", True, 2),
]


# Scenarios whose homes have appliances of their own instead.
CUSTOM_SCENARIOS = [("custom_appliance", "default", True, 1, [POOL_PUMP])]


def scenario_plans(appliances: DataFrame, scenarios=SCENARIOS, keys=("home_id",), custom=CUSTOM_SCENARIOS):
    """Key every appliance and home by scenario as well.

    The scenario list is a small fixed parameter; each appliance row is
    repeated once per scenario (``explode`` of a literal array), so the work
    is the scenario count times the single run and partitions stay keyed by
    (scenario, home).  Homes of a ``custom`` scenario get its appliances."""
    def plan(s, t, a, m):
        return F.struct(F.lit(s).alias("scenario_id"), F.lit(t).alias("tariff_id"),
                        F.lit(a).alias("allow_simultaneous"), F.lit(m).alias("max_simultaneous"))

    homes = appliances.select(*keys).distinct()
    plans = homes.withColumn("_s", F.explode(F.array(*[plan(*s) for s in scenarios], *[plan(*s[:4]) for s in custom])))
    plans = plans.select("_s.scenario_id", *keys, "_s.tariff_id", "_s.allow_simultaneous", "_s.max_simultaneous")
    keyed = appliances.withColumn("scenario_id", F.explode(F.array(*[F.lit(s[0]) for s in scenarios])))
    own = [F.struct(F.lit(s[0]).alias("scenario_id"), F.lit(a[0]).alias("appliance"), F.lit(float(a[2])).alias("runtime_hours"),
                    F.lit(a[3]).alias("earliest_start"), F.lit(a[4]).alias("latest_finish"),
                    F.lit(float(a[5])).alias("power_rating")) for s in custom for a in s[4]]
    if own:
        keyed = keyed.unionByName(homes.select(*keys, F.inline(F.array(*own))), allowMissingColumns=True)
    return keyed, plans
