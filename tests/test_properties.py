"""Property tests (hypothesis): flow vs brute force, windows and as-of vs pandas."""

import datetime as dt
import itertools

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wattgrid.operators.asof import merge_nearest
from wattgrid.operators.features import add_lag_features, add_rolling_features
from wattgrid.operators.flow import min_cost_assignment

T0 = dt.datetime(2024, 1, 1)

appliance = st.tuples(st.integers(0, 20), st.integers(1, 4), st.integers(1, 2),
                      st.lists(st.integers(1, 9), min_size=24, max_size=24))


@settings(max_examples=300, deadline=None)
@given(st.lists(appliance, min_size=1, max_size=3), st.integers(1, 2))
def test_flow_matches_brute_force(apps, cap):
    needs, allowed, costs = [], [], []
    for start, width, need, cost in apps:
        needs.append(min(need, width))
        allowed.append(range(start, start + width))
        costs.append(cost)
    best = None
    for combo in itertools.product(*[itertools.combinations(a, n) for a, n in zip(allowed, needs)]):
        load = np.zeros(24, int)
        for hours in combo:
            load[list(hours)] += 1
        if load.max() <= cap:
            c = sum(costs[i][h] for i, hours in enumerate(combo) for h in hours)
            best = c if best is None else min(best, c)
    got = min_cost_assignment(needs, [(i, h, costs[i][h]) for i in range(len(needs)) for h in allowed[i]], cap)
    if best is None:
        assert got is None
    else:
        assert got is not None
        load = np.zeros(24, int)
        for i, h in got:
            assert h in allowed[i]
            load[h] += 1
        assert load.max() <= cap
        assert sorted(i for i, _ in got) == sorted(i for i, n in enumerate(needs) for _ in range(n))
        assert sum(costs[i][h] for i, h in got) == best


values = st.lists(st.one_of(st.none(), st.floats(-100, 100, allow_nan=False).map(lambda x: round(x, 2))),
                  min_size=1, max_size=25)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values, st.integers(1, 5))
def test_lags_and_rolling_match_pandas(spark, vals, window):
    rows = [(1, T0 + dt.timedelta(minutes=15 * i), v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "home_id long, ts timestamp_ntz, x double")
    out = add_rolling_features(add_lag_features(df, ["x"], [1, 3]), ["x"], [window]).orderBy("ts").toPandas()
    s = pd.Series([np.nan if v is None else v for v in vals], dtype=float)
    r = s.rolling(window, min_periods=1)
    for name, exp in ((f"x_rolling_mean_{window}", r.mean()), (f"x_rolling_sum_{window}", r.sum()),
                      (f"x_rolling_std_{window}", r.std()), ("x_lag_1", s.shift(1)), ("x_lag_3", s.shift(3))):
        got = out[name].astype(float).to_numpy()
        np.testing.assert_allclose(got, exp.to_numpy(), rtol=1e-9, atol=1e-9, equal_nan=True, err_msg=name)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 200), min_size=1, max_size=30), st.lists(st.integers(0, 200), min_size=1, max_size=20),
       st.sampled_from(["10min", "30min", "1h"]), st.sampled_from([None, 1, 5]))
def test_asof_matches_pandas(spark, left_min, right_min, tol, salt):
    lm, rm = sorted(left_min), sorted(right_min)
    left = spark.createDataFrame([(i, T0 + dt.timedelta(minutes=m)) for i, m in enumerate(lm)],
                                 "lid long, ts timestamp_ntz")
    right = spark.createDataFrame([(T0 + dt.timedelta(minutes=m), float(i), i) for i, m in enumerate(rm)],
                                  "ts timestamp_ntz, w double, rseq long")
    got = [r["w"] for r in merge_nearest(left, right, tolerance=tol, right_order="rseq",
                                         salt=salt).orderBy("lid").collect()]
    lp = pd.DataFrame({"ts": [T0 + dt.timedelta(minutes=m) for m in lm]})
    rp = pd.DataFrame({"ts": [T0 + dt.timedelta(minutes=m) for m in rm], "w": [float(i) for i in range(len(rm))]})
    exp = pd.merge_asof(lp, rp, on="ts", direction="nearest", tolerance=pd.Timedelta(tol))["w"]
    assert got == [None if pd.isna(x) else x for x in exp]
