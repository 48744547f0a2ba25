"""Pivot, resample, gap fill, fills, outliers, scaling, calendar."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattgrid.functions.calendar import add_time_features
from wattgrid.operators.impute import handle_missing
from wattgrid.operators.outliers import remove_outliers
from wattgrid.operators.pivot import pivot_first
from wattgrid.operators.resample import resample_mean
from wattgrid.operators.scale import apply_minmax, fit_minmax, minmax_scale
from wattgrid.sources.readings import filter_variables

T0 = dt.datetime(2024, 1, 1)


def long_df(spark, rows):
    return spark.createDataFrame(rows, "home_id long, channel string, ts timestamp_ntz, watts double, seq long")


def series_df(spark, values, step_minutes=60, col="x", home=1):
    rows = [(home, T0 + dt.timedelta(minutes=step_minutes * i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"home_id long, ts timestamp_ntz, {col} double")


def col_values(df, col="x"):
    return [r[col] for r in df.orderBy("home_id", "ts").collect()]


def test_e1_pivot_first_drops_null_only_rows(spark):
    t = [T0 + dt.timedelta(seconds=i) for i in range(4)]
    rows = [(1, "V1", t[1], None, 0), (1, "V1", t[1], 5.0, 1), (1, "V10", t[1], 7.0, 2),
            (1, "V2", t[2], 8.0, 3), (1, "V1", t[3], None, 4), (1, "V1", t[1], 6.0, 5)]
    out = pivot_first(long_df(spark, rows), ["V1", "V10", "V2"]).orderBy("ts").collect()
    assert [(r["V1"], r["V10"], r["V2"]) for r in out] == [(5.0, 7.0, None), (None, None, 8.0)]


def test_e2_variable_filter(spark):
    ids = ["xTimeSeriesVariable1", "TimeSeriesVariable11", "TimeSeriesVariable10", "TimeSeriesVariable0",
           "TimeSeriesVariable9"]
    df = spark.createDataFrame([(i,) for i in ids], "variable_id string")
    kept = {r[0] for r in filter_variables(df).collect()}
    assert kept == {"xTimeSeriesVariable1", "TimeSeriesVariable10", "TimeSeriesVariable9"}


def test_e6_resample_seven_minutes_anchored_at_midnight(spark):
    rows = [(1, T0 + dt.timedelta(minutes=3), 1.0), (1, T0 + dt.timedelta(minutes=5), 2.0),
            (1, T0 + dt.timedelta(minutes=20), 4.0)]
    df = spark.createDataFrame(rows, "home_id long, ts timestamp_ntz, x double")
    out = resample_mean(df, ["x"], "7min").orderBy("ts").collect()
    assert [(r["ts"], r["x"]) for r in out] == [
        (T0, 1.5), (T0 + dt.timedelta(minutes=7), None), (T0 + dt.timedelta(minutes=14), 4.0)]


@pytest.mark.parametrize("interval", ["15min", "1h", "7min"])
def test_resample_matches_pandas(spark, interval):
    rng = np.random.default_rng(7)
    rows, frames = [], []
    for home in (1, 2):
        secs = np.sort(rng.choice(3 * 86400, size=120, replace=False)) + 3600 * 5 * home
        t = [T0 + dt.timedelta(seconds=int(s)) for s in secs]
        v = rng.normal(100, 20, size=len(t)).round(2)
        v[rng.random(len(v)) < 0.2] = np.nan
        rows += [(home, a, None if math.isnan(b) else float(b)) for a, b in zip(t, v)]
        pdf = pd.DataFrame({"x": v}, index=pd.DatetimeIndex(t, name="ts")).resample(
            interval.replace("h", "h")).mean()
        pdf["home_id"] = home
        frames.append(pdf.reset_index())
    df = spark.createDataFrame(rows, "home_id long, ts timestamp_ntz, x double")
    got = resample_mean(df, ["x"], interval).toPandas().sort_values(["home_id", "ts"]).reset_index(drop=True)
    exp = pd.concat(frames).sort_values(["home_id", "ts"]).reset_index(drop=True)
    assert list(got["ts"]) == list(exp["ts"])
    np.testing.assert_allclose(got["x"].astype(float), exp["x"].astype(float), equal_nan=True)


def test_e7_ffill_then_bfill(spark):
    df = series_df(spark, [None, 1.0, None])
    assert col_values(handle_missing(df, ["x"], "ffill")) == [1.0, 1.0, 1.0]


def test_e8_time_interpolation(spark):
    hours = [0, 1, 2, 4, 5]
    vals = [None, 1.0, None, 3.0, None]
    rows = [(1, T0 + dt.timedelta(hours=h), v) for h, v in zip(hours, vals)]
    df = spark.createDataFrame(rows, "home_id long, ts timestamp_ntz, x double")
    got = col_values(handle_missing(df, ["x"], "interpolate"))
    assert got[0] is None and got[1] == 1.0 and got[3] == 3.0 and got[4] == 3.0
    assert got[2] == pytest.approx(1.6666667)


@pytest.mark.parametrize("method", ["ffill", "bfill", "interpolate", "drop"])
def test_fills_match_pandas(spark, method):
    rng = np.random.default_rng(3)
    v = rng.normal(10, 3, 60).round(3)
    v[rng.random(60) < 0.35] = np.nan
    v[:3] = np.nan
    v[-2:] = np.nan
    t = [T0 + dt.timedelta(hours=int(h)) for h in np.cumsum(rng.integers(1, 4, 60))]
    pdf = pd.DataFrame({"x": v}, index=pd.DatetimeIndex(t))
    exp = {"ffill": pdf.ffill().bfill(), "bfill": pdf.bfill().ffill(),
           "interpolate": pdf.interpolate(method="time"), "drop": pdf.dropna()}[method]
    rows = [(1, a, None if math.isnan(b) else float(b)) for a, b in zip(t, v)]
    df = spark.createDataFrame(rows, "home_id long, ts timestamp_ntz, x double")
    got = handle_missing(df, ["x"], method).orderBy("ts").toPandas()
    np.testing.assert_allclose(got["x"].astype(float).values, exp["x"].values, equal_nan=True)


def test_unknown_fill_method_is_an_error(spark):
    with pytest.raises(ValueError):
        handle_missing(series_df(spark, [1.0, 2.0]), ["x"], "median")


def test_e9_zscore_removes_only_the_spike(spark):
    vals = [10, 12, 11, 13, 12, 11, 10, 12, 11, 12, 13, 100]
    out = col_values(remove_outliers(series_df(spark, [float(v) for v in vals]), ["x"], 3.0))
    assert out == [float(v) for v in vals[:-1]]


def test_e10_constant_column_drops_every_row(spark):
    df = series_df(spark, [2.0, 2.0, 2.0])
    assert remove_outliers(df, ["x"], 3.0).count() == 0
    assert remove_outliers(df, ["x"], 3.0, keep_constant=True).count() == 3


def test_e11_minmax_constant_column_is_zero(spark):
    df = series_df(spark, [5.0, 5.0])
    assert col_values(minmax_scale(df, ["x"])) == [0.0, 0.0]


def test_minmax_params_reused_without_clipping(spark):
    fit_df = series_df(spark, [0.0, 10.0])
    params = fit_minmax(fit_df, ["x"])
    assert {(r["column"], r["data_min"], r["data_max"]) for r in params.collect()} == {("x", 0.0, 10.0)}
    out = col_values(apply_minmax(series_df(spark, [5.0, 20.0]), params, ["x"]))
    assert out == [0.5, 2.0]


def test_e12_e13_calendar(spark):
    rows = [(1, dt.datetime(2024, 1, 1, h), 1.0) for h in (0, 6, 23)] + [(1, dt.datetime(2024, 1, 6, 12), 1.0)]
    df = spark.createDataFrame(rows, "home_id long, ts timestamp_ntz, x double")
    out = add_time_features(df).orderBy("ts").collect()
    assert out[0]["day_of_week"] == 0 and out[0]["is_weekend"] == 0
    assert out[3]["day_of_week"] == 5 and out[3]["is_weekend"] == 1
    assert [round(r["hour_sin"], 9) for r in out[:3]] == [0.0, 1.0, round(-0.258819045, 9)]
    assert [round(r["hour_cos"], 6) for r in out[:3]] == [1.0, 0.0, round(0.965925826, 6)]
    assert (out[0]["day_of_month"], out[0]["month"], out[2]["hour"]) == (1, 1, 23)


def test_missing_channel_is_ignored_by_outlier_filter(spark):
    df = series_df(spark, [1.0, 2.0, 3.0]).withColumn("y", F.lit(None).cast("double"))
    assert remove_outliers(df, ["x", "y"], 3.0).count() == 3


def test_unique_readings_path_equals_pivot_path(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(300):
        t = T0 + dt.timedelta(seconds=int(i * 97 + rng.integers(0, 50)))
        rows.append((int(rng.integers(0, 3)), ["a", "b", "c"][i % 3], t,
                     None if i % 17 == 0 else float(rng.integers(0, 1000)), i))
    df = long_df(spark, rows)
    from wattgrid.operators.resample import resample_readings
    exact = resample_readings(df, ["a", "b", "c"], "15min").orderBy("home_id", "ts").collect()
    fast = resample_readings(df, ["a", "b", "c"], "15min", unique=True).orderBy("home_id", "ts").collect()
    assert exact == fast


def test_default_path_keeps_the_first_duplicate(spark):
    from wattgrid.operators.resample import resample_readings
    rows = [(1, "a", T0, 10.0, 2), (1, "a", T0, 30.0, 1), (1, "a", T0 + dt.timedelta(minutes=1), 20.0, 3)]
    out = resample_readings(long_df(spark, rows), ["a"], "15min").collect()
    assert out[0]["a"] == 25.0  # first of the duplicates (seq 1 -> 30) and 20
