
import itertools
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from wattgrid.constants import DEFAULT_APPLIANCES, ELECTRIC_VEHICLE, POOL_PUMP, TARIFFS
from wattgrid.operators.flow import min_cost_assignment
from wattgrid.operators.schedule import optimize_schedules, validate_appliances, validate_tariffs
from wattgrid.plans import reports
from wattgrid.sources.tables import tariff_table

APP_SCHEMA = ("home_id long, appliance string, channel string, runtime_hours double, earliest_start double, "
              "latest_finish double, power_rating double")


def apps_df(spark, apps, home=1):
    rows = [(home, a[0], a[1], float(a[2]), float(a[3]), float(a[4]), float(a[5])) for a in apps]
    return spark.createDataFrame(rows, APP_SCHEMA)


def plan_df(spark, tariff="default", cap=2, allow=True, home=1):
    return spark.createDataFrame([(home, tariff, allow, cap)],
                                 "home_id long, tariff_id string, allow_simultaneous boolean, max_simultaneous int")


def run(spark, apps, tariff="default", cap=2, allow=True):
    res = optimize_schedules(apps_df(spark, apps), tariff_table(spark), plan_df(spark, tariff, cap, allow))
    return res, res.homes.collect()[0]


@pytest.mark.parametrize("apps,tariff,cap,allow,orig,opt", [
    (DEFAULT_APPLIANCES, "default", 2, True, 1.0920, 1.0920),
    (DEFAULT_APPLIANCES, "default", 1, False, 1.0920, 1.2620),
    (DEFAULT_APPLIANCES, "flat", 2, True, 1.7100, 1.7100),
    (DEFAULT_APPLIANCES, "steep", 2, True, 1.0200, 1.0200),
    ([POOL_PUMP], "default", 1, True, 0.7200, 0.7200),
])
def test_reference_goldens(spark, apps, tariff, cap, allow, orig, opt):
    res, home = run(spark, apps, tariff, cap, allow)
    assert home["status"] == "optimal"
    assert home["original_cost"] == pytest.approx(orig, abs=1e-9)
    assert home["optimized_cost"] == pytest.approx(opt, abs=1e-9)
    per_hour = reports.appliances_per_hour(res.schedule).agg(F.max("n_on")).collect()[0][0]
    assert per_hour <= (cap if allow else 1)
    runs = res.schedule.groupBy("appliance").agg(F.sum("is_on").alias("n"), F.first("runtime_hours").alias("r"))
    assert all(r["n"] == math.ceil(r["r"]) for r in runs.collect())
    outside = res.schedule.filter((F.col("is_on") == 1) & ~F.col("in_window")).count()
    assert outside == 0


def test_e20_greedy_trap_needs_the_exact_path(spark):
    _, home = run(spark, DEFAULT_APPLIANCES, "default", 1, False)
    assert home["path"] == "flow"
    assert home["optimized_cost"] == pytest.approx(1.2620)
    assert home["optimized_cost"] != pytest.approx(1.2920)


def test_e21_ev_window_over_midnight_is_rejected(spark):
    checked = validate_appliances(apps_df(spark, [ELECTRIC_VEHICLE, POOL_PUMP])).collect()
    assert {r["appliance"]: r["violation"] for r in checked} == {
        "Electric Vehicle": "runtime longer than the window", "Pool Pump": None}
    with pytest.raises(ValueError, match="runtime longer than the window"):
        validate_appliances(apps_df(spark, [ELECTRIC_VEHICLE]), strict=True)
    _, home = run(spark, [ELECTRIC_VEHICLE, POOL_PUMP])
    assert home["status"] == "invalid"


def test_e22_infeasible_after_validation(spark):
    three = [(f"A{i}", "c", 1.0, 10.0, 11.0, 1000.0) for i in range(3)]
    _, home = run(spark, three, cap=2)
    assert home["status"] == "infeasible"
    with pytest.raises(RuntimeError, match="status.*infeasible"):
        optimize_schedules(apps_df(spark, three), tariff_table(spark), plan_df(spark, "default", 2), strict=True)
    _, home = run(spark, [("B", "c", 1.5, 10.5, 12.0, 1000.0)], cap=2)
    assert home["status"] == "infeasible"


def test_e23_peak_to_average(spark):
    res, _ = run(spark, DEFAULT_APPLIANCES, "default", 2)
    sp = reports.savings_and_peak(res.schedule).collect()[0]
    assert sp["original_peak_to_avg"] == pytest.approx(2 / 1.5)
    assert sp["optimized_peak_to_avg"] == pytest.approx(2 / 1.5)
    assert sp["percent_savings"] == pytest.approx(0.0)


def test_tariff_validation(spark):
    t = tariff_table(spark).union(spark.createDataFrame([("short", 0, 0.1)], "tariff_id string, hour int, price double"))
    valid = {r["tariff_id"]: r["valid"] for r in validate_tariffs(t).collect()}
    assert valid == {"default": True, "flat": True, "steep": True, "short": False}
    for bad in (None, float("nan"), float("inf")):
        rows = [("odd", h, 0.1 if h else bad) for h in range(24)]
        odd = spark.createDataFrame(rows, "tariff_id string, hour int, price double")
        assert [r["valid"] for r in validate_tariffs(odd).collect()] == [False]


def test_every_home_has_a_status(spark):
    one = [("D", "c", 1.0, 0.0, 24.0, 1000.0)]
    apps = apps_df(spark, one, 1).union(apps_df(spark, one, 2)).union(apps_df(spark, one * 2, 4))
    plans = plan_df(spark, home=1).union(plan_df(spark, home=3)).union(plan_df(spark, home=4))
    homes = optimize_schedules(apps, tariff_table(spark), plans).homes
    assert {r["home_id"]: r["status"] for r in homes.collect()} == {
        1: "optimal", 2: "no plan", 3: "no appliances", 4: "invalid"}
    assert [r["violation"] for r in validate_appliances(apps_df(spark, one * 2)).collect()] == ["name used twice in the home"] * 2


def test_large_home_is_solved_quickly():
    rnd = random.Random(2)
    needs, cells = [], []
    for i in range(320):
        start, power = rnd.randint(0, 18), rnd.choice([1000, 1500, 2000])
        needs.append(rnd.randint(1, 2))
        cells += [(i, h, power * rnd.choice([8, 12, 14, 16, 18, 35])) for h in range(start, start + rnd.randint(3, 6))]
    t0 = time.perf_counter()
    got = min_cost_assignment(needs, cells, 24)
    assert time.perf_counter() - t0 < 1
    assert [sum(i == j for i, _ in got) for j in range(320)] == needs
    assert max(sum(h == k for _, h in got) for k in range(24)) <= 24


def test_summary_labels_and_formats(spark):
    res, _ = run(spark, DEFAULT_APPLIANCES, "default", 2)
    rows = {r["Appliance"]: r for r in reports.schedule_summary(res.schedule, labels=True).collect()}
    dish = rows["Dishwasher"]
    assert dish["Original Start"] == "00:00" and dish["Original End"] == "02:00"
    assert dish["Original Cost (£)"] == "0.1920"
    assert rows["Tumble Dryer"]["Runtime (h)"] == 1.5


def brute_force(needs, allowed, costs, cap):
    best = None
    options = [list(itertools.combinations(sorted(allowed[i]), needs[i])) for i in range(len(needs))]
    for combo in itertools.product(*options):
        load = [0] * 24
        for hours in combo:
            for h in hours:
                load[h] += 1
        if max(load) > cap:
            continue
        c = sum(costs[i][h] for i, hours in enumerate(combo) for h in hours)
        best = c if best is None else min(best, c)
    return best


def canonical(needs, allowed, costs, cap):
    """The cells of the least-cost schedule with the least binary number."""
    best = None
    for combo in itertools.product(*[list(itertools.combinations(sorted(a), n)) for a, n in zip(allowed, needs)]):
        cells = [(i, h) for i, hours in enumerate(combo) for h in hours]
        if max(sum(h == k for _, h in cells) for k in range(24)) <= cap:
            value = (sum(costs[i][h] for i, h in cells), sum(1 << (24 * i + h) for i, h in cells))
            best = value if best is None else min(best, value)
    return best[1]


def test_flow_equals_brute_force_on_random_cases():
    rnd = random.Random(11)
    infeasible = 0
    for _ in range(300):
        n = rnd.randint(1, 3)
        needs, allowed, costs = [], [], []
        for _ in range(n):
            start = rnd.randint(0, 20)
            width = rnd.randint(1, 4)
            needs.append(rnd.randint(1, min(2, width)))
            allowed.append(list(range(start, start + width)))
            costs.append({h: rnd.randint(1, 9) for h in range(24)})
        cap = rnd.randint(1, 2)
        cells = [(i, h, costs[i][h]) for i in range(n) for h in allowed[i]]
        got = min_cost_assignment(needs, cells, cap)
        exp = brute_force(needs, allowed, costs, cap)
        if exp is not None:
            assert sum(1 << (24 * i + h) for i, h in got) == canonical(needs, allowed, costs, cap)
        if exp is None:
            infeasible += 1
            assert got is None
        else:
            assert got is not None
            assert sum(costs[i][h] for i, h in got) == exp
    assert infeasible > 0


def test_default_tariff_matches_reference_values():
    assert len(TARIFFS["default"]) == 24 and TARIFFS["default"][17] == 0.40


def big_homes(spark, n=40):
    rng = random.Random(8)
    apps, plans = [], []
    for home in range(n):
        for k in range(rng.randint(10, 14)):
            first = rng.randrange(0, 14)
            apps.append((home, f"app {k}", None, rng.choice([1.0, 1.5, 2.0, 3.0, 4.0]), float(first),
                         float(first + rng.randint(8, 10)), float(rng.choice([500, 750, 1200, 2500]))))
        plans.append((home, rng.choice(sorted(TARIFFS)), True, rng.choice([2, 3, 4])))
    return spark.createDataFrame(apps, APP_SCHEMA), spark.createDataFrame(
        plans, "home_id long, tariff_id string, allow_simultaneous boolean, max_simultaneous int")


def test_schedules_of_big_homes_are_proven_in_sql(spark):
    """Feasibility and complementary slackness of homes with ten and more
    appliances, checked in another engine from the schedule and the hour prices."""
    import duckdb

    apps, plans = big_homes(spark)
    res = optimize_schedules(apps, tariff_table(spark), plans)
    cert = res.certificate.toPandas()
    assert len(cert) > 30 and cert.proven.all() and cert.feasible.all() and cert.slack.all()
    assert (cert.cost == cert.bound).all() and (cert.n_appliances >= 10).all()
    con = duckdb.connect()
    con.register("s", res.schedule.select("home_id", "appliance", "hour", "price", "power_rating", "in_window", "is_on", "need", "cap").toPandas())
    con.register("p", res.certificate.selectExpr("home_id", "posexplode(hour_prices) AS (hour, worth)").toPandas())
    bad = con.execute("""
        WITH c AS (SELECT s.*, p.worth, round(power_rating * price * 1000000)::BIGINT + p.worth AS priced FROM s JOIN p USING (home_id, hour)),
        appliance AS (SELECT home_id, appliance, sum(is_on) AS n, any_value(need) AS need, max(priced) FILTER (WHERE is_on = 1) AS dearest,
                             min(priced) FILTER (WHERE is_on = 0 AND in_window) AS cheapest, bool_or(is_on = 1 AND NOT in_window) AS outside
                      FROM c GROUP BY ALL),
        hours AS (SELECT home_id, hour, sum(is_on) AS n, any_value(cap) AS cap, any_value(worth) AS worth FROM c GROUP BY ALL)
        SELECT (SELECT count(*) FROM appliance WHERE n <> need OR outside OR dearest > cheapest)
             + (SELECT count(*) FROM hours WHERE n > cap OR worth < 0 OR (worth > 0 AND n < cap))""").fetchone()[0]
    assert bad == 0
    paths = {r["path"] for r in res.homes.collect()}
    assert "flow" in paths
    # A schedule that is moved by an hour is not proven any more.
    from wattgrid.operators.schedule import certify, home_checks, appliance_rows, tariff_rows

    ts = validate_tariffs(tariff_table(spark))
    checked = validate_appliances(apps)
    rows = appliance_rows(checked, home_checks(checked, plans, ts), tariff_rows(tariff_table(spark), ts))
    dear = rows.withColumns({"chosen": F.slice(F.reverse("allowed"), F.lit(1), F.col("need")),
                             "hour_prices": F.array_repeat(F.lit(0).cast("long"), 24)})
    flat = {r["home_id"] for r in plans.where("tariff_id = 'flat'").collect()}
    assert not any(r["proven"] for r in certify(dear).collect() if r["home_id"] not in flat)


def test_bad_rows_get_a_status_and_end_no_job(spark):
    rows = [(home, f"a{k}", None, 2.0, 0.0, 24.0, power) for home, power in enumerate(
        [1000.0, float("nan"), float("inf"), -1.0, None, 1000.0, 1000.0, 1000.0, 0.0]) for k in range(2)]
    rows.append((9, "inf", None, float("inf"), 0.0, 24.0, 1000.0))
    apps = spark.createDataFrame(rows, APP_SCHEMA)
    plans = [(h, "flat", True, 1) for h in (0, 1, 2, 3, 4, 8, 9)]
    plans += [(5, "flat", True, None), (6, "flat", True, 2), (6, "flat", True, 2), (7, None, True, 2), (10, "flat", False, None)]
    res = optimize_schedules(apps, tariff_table(spark), spark.createDataFrame(
        plans, "home_id long, tariff_id string, allow_simultaneous boolean, max_simultaneous int"))
    homes = res.homes.collect()
    assert len(homes) == 11
    assert {r["home_id"]: r["status"] for r in homes} == {
        0: "optimal", **dict.fromkeys((1, 2, 3, 4, 5, 6, 7, 9), "invalid"), 8: "optimal", 10: "no appliances"}
    assert {r["home_id"] for r in res.schedule.select("home_id").distinct().collect()} == {0, 8}
    assert res.schedule.where("is_on = 1").count() == 8
    shown = {r["home_id"]: r["violation"] for r in validate_appliances(apps).collect()}
    assert shown[1] == shown[2] == shown[3] == "power not finite or negative" and shown[4] == "power_rating has no value"
