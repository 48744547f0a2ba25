"""Lags, rolling, target, split, sequences, metrics."""

import datetime as dt

import pytest

from wattgrid.functions.metrics import regression_metrics
from wattgrid.operators.features import add_lag_features, add_rolling_features, prepare_features
from wattgrid.operators.sequences import make_sequences
from wattgrid.operators.split import chrono_split, split_ranges

T0 = dt.datetime(2024, 1, 1)


def series(spark, values, col="x"):
    rows = [(1, T0 + dt.timedelta(minutes=15 * i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"home_id long, ts timestamp_ntz, {col} double")


def column(df, name):
    return [r[name] for r in df.orderBy("ts").collect()]


def test_e14_rolling_four(spark):
    out = add_rolling_features(series(spark, [1.0, 2.0, 4.0, 8.0, 16.0]), ["x"], [4])
    assert column(out, "x_rolling_mean_4") == pytest.approx([1, 1.5, 2.3333333, 3.75, 7.5])
    assert column(out, "x_rolling_sum_4") == [1, 3, 7, 15, 30]
    std = column(out, "x_rolling_std_4")
    assert std[0] is None
    assert std[1:] == pytest.approx([0.707106781, 1.527525232, 3.095695937, 6.191391874])


def test_e15_rolling_two_with_gaps(spark):
    out = add_rolling_features(series(spark, [1.0, None, 4.0, 5.0]), ["x"], [2])
    std = column(out, "x_rolling_std_2")
    assert std[:3] == [None, None, None] and std[3] == pytest.approx(0.7071068)
    out2 = add_rolling_features(series(spark, [None, None, 4.0, 5.0]), ["x"], [2])
    assert column(out2, "x_rolling_sum_2") == [None, None, 4.0, 9.0]


def test_lags_skip_unknown_columns(spark):
    out = add_lag_features(series(spark, [1.0, 2.0, 3.0]), ["x", "nope"], [1, 2])
    assert "nope_lag_1" not in out.columns
    assert column(out, "x_lag_2") == [None, None, 1.0]


def test_prepare_features_drops_edge_rows(spark):
    df = series(spark, [float(i) for i in range(30)])
    out = prepare_features(df, "x", ["x"], [1, 2, 3, 4], [4, 8, 12], 4)
    assert out.count() == 30 - 4 - 4
    assert column(out, "target")[0] == 8.0


@pytest.mark.parametrize("n,bounds", [(90, (62, 76)), (100, (70, 85)), (7, (4, 5))])
def test_e16_split_bounds(spark, n, bounds):
    out = chrono_split(series(spark, [float(i) for i in range(n)]))
    splits = column(out, "split")
    assert splits.count("train") == bounds[0]
    assert splits.count("train") + splits.count("val") == bounds[1]
    ranges = {r["split"]: r["n_rows"] for r in split_ranges(out).collect()}
    assert sum(ranges.values()) == n


def test_split_ratios_must_sum_to_one(spark):
    with pytest.raises(ValueError):
        chrono_split(series(spark, [1.0]), 0.5, 0.2, 0.2)


def test_e18_sequence_count(spark):
    df = series(spark, [float(i) for i in range(30)])
    df = df.withColumn("target", df.x * 10)
    seqs = make_sequences(df, ["x"], 24, by_split=False).orderBy("ts").collect()
    assert len(seqs) == 6
    assert seqs[0]["y"] == 240.0
    assert [v[0] for v in seqs[0]["x"]] == [float(i) for i in range(24)]


def test_e17_metrics(spark):
    rows = [(0.0, 1.0), (2.0, 1.0), (4.0, 5.0), (5.0, 5.0)]
    df = spark.createDataFrame(rows, "y_true double, y_pred double")
    m = regression_metrics(df).collect()[0]
    assert m["rmse"] == pytest.approx(0.8660254)
    assert m["mae"] == pytest.approx(0.75)
    assert m["mape"] == pytest.approx(25.0)
    zero = regression_metrics(spark.createDataFrame([(0.0, 1.0)], "y_true double, y_pred double")).collect()[0]
    assert zero["mape"] == 0.0


def test_rolling_statistics_use_no_sliding_frame(spark):
    """Frames of several functions and rows are summed anew for each row; lags are not."""
    import math
    import statistics

    from wattgrid.operators.features import add_rolling_features

    values = [1.5, None, 2.25, -3.0, None, None, None, None, 7.125, 0.1]
    rows = [(1, dt.datetime(2024, 1, 1, k), v) for k, v in enumerate(values)]
    made = add_rolling_features(spark.createDataFrame(rows, "home_id long, ts timestamp_ntz, a double"), ["a"], [2, 4])
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert "avg(" not in plan and "stddev" not in plan
    for k, r in enumerate(made.orderBy("ts").collect()):
        for w in (2, 4):
            seen = [v for v in values[max(0, k - w + 1):k + 1] if v is not None]
            assert r[f"a_rolling_sum_{w}"] == (sum(seen) if seen else None)
            assert r[f"a_rolling_mean_{w}"] == (sum(seen) / len(seen) if seen else None)
            if len(seen) > 1:
                assert math.isclose(r[f"a_rolling_std_{w}"], statistics.stdev(seen), abs_tol=1e-12)
            else:
                assert r[f"a_rolling_std_{w}"] is None


def test_rounding_is_that_of_two_steps(spark):
    from pyspark.sql import functions as F

    from wattgrid.plans.catalog import rounded

    odd = [0.0, -0.0, 0.0000005, 0.00000049999999996, -1.0000005, 2.5e-7, 999.9999995, 1e15, -1e300, float("inf"), float("nan"), None, 0.1234564999999]
    rows = [(x,) for x in odd] + [((k * 7919 % 100003) / 100003 * (-1) ** k * (1 + k % 12),) for k in range(3000)]
    df = spark.createDataFrame(rows, "x double").withColumn("i", F.monotonically_increasing_id())
    want = df.selectExpr("CAST(round(round(x, 9), 6) AS STRING) AS x", "i").orderBy("i").collect()
    assert rounded(df).selectExpr("CAST(x AS STRING) AS x", "i").orderBy("i").collect() == want
