"""C3 end to end on the sf0.001 tables, and the forecast quality check."""

import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

from wattgrid.operators.pivot import pivot_first
from wattgrid.plans import forecast
from wattgrid.plans.household import run_household_job
from wattgrid.sources.tables import (EVENT_CHANNELS, appliances_from_part, plans_from_appliances,
                                     readings_from_events, table, tariff_table)

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")
def test_household_job_writes_every_output(spark, tmp_dir):
    wide = pivot_first(readings_from_events(table(spark, SF, "events")), EVENT_CHANNELS)
    apps = appliances_from_part(table(spark, SF, "part"))
    out = run_household_job(spark, wide, apps, tariff_table(spark), plans_from_appliances(apps), tmp_dir,
                            interval="1h", boost_params={"rounds": 5})
    assert {r["split"] for r in out["metrics"].collect()} == {"train", "val", "test"}
    assert out["results_summary"].count() == 7
    for name in ("optimized_schedule", "schedule_summary", "results_summary", "metrics", "predictions"):
        assert os.path.isdir(f"{tmp_dir}/{name}")
    summary = spark.read.option("header", True).csv(f"{tmp_dir}/results_summary").collect()
    assert summary[0]["Metric"] == "Prediction RMSE"


def test_forecast_beats_last_value_on_a_daily_cycle(spark):
    rows = []
    t0 = dt.datetime(2024, 1, 1)
    for home in (1, 2):
        for i in range(24 * 20):
            t = t0 + dt.timedelta(hours=i)
            v = 100 + 50 * math.sin(2 * math.pi * (t.hour + home) / 24) + (i * 7919 % 13)
            rows.append((home, t, v))
    df = spark.createDataFrame(rows, "home_id long, ts timestamp_ntz, Aggregate double")
    from wattgrid.operators.features import feature_names, prepare_features
    from wattgrid.operators.split import chrono_split
    from wattgrid.functions.calendar import add_time_features
    frame = chrono_split(prepare_features(add_time_features(df), "Aggregate", ["Aggregate"], [1, 2, 3, 4],
                                          [4, 8, 12], 4))
    feats = feature_names(frame)
    model = forecast.train_forecaster(frame, feats, params={"rounds": 30, "max_depth": 4})
    pred = forecast.predict(model, frame).filter(F.col("split") == "test")
    m = forecast.evaluate(pred).collect()[0]
    naive = (frame.filter(F.col("split") == "test")
             .agg(F.sqrt(F.avg((F.col("target") - F.col("Aggregate")) ** 2))).collect()[0][0])
    assert m["rmse"] < naive
    top = forecast.feature_importances(model, 5).collect()
    assert len(top) == 5 and top[0]["importance"] >= top[-1]["importance"]


def test_scaler_fitted_on_train_rows_only(spark):
    from wattgrid.operators.features import prepare_features
    from wattgrid.operators.split import chrono_split
    from wattgrid.plans.household import fit_scaler_on_train

    t0 = dt.datetime(2024, 1, 1)
    rows = [(1, t0 + dt.timedelta(hours=i), float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "home_id long, ts timestamp_ntz, Aggregate double")

    def featurize(s):
        return chrono_split(prepare_features(s, "Aggregate", ["Aggregate"], [1], [2], 1))

    scaled = fit_scaler_on_train(df, ["Aggregate"], featurize)
    split = featurize(df).select("ts", "split")
    out = scaled.join(split, "ts").groupBy("split").agg(F.min("Aggregate").alias("lo"), F.max("Aggregate").alias("hi"))
    rng = {r["split"]: (r["lo"], r["hi"]) for r in out.collect()}
    assert rng["train"][0] == 0.0 and rng["train"][1] == 1.0
    assert rng["test"][1] > 1.0  # no clipping outside the fitted range


def test_scratch_tables_are_deleted_at_the_end_of_the_block(spark):
    from pyspark.errors import AnalysisException

    from wattgrid.session import materialize, scratch_tables

    outside = materialize(spark.range(3))
    with scratch_tables(spark):
        inside = materialize(spark.range(5))
        assert inside.count() == 5
        path = inside.inputFiles()[0].rsplit("/", 1)[0]
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)
    assert outside.count() == 3


def test_job_with_weather_writes_the_wide_schedule(spark, tmp_dir):
    rows = [(1, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), 100.0 + i % 24, 5.0 + i % 7) for i in range(24 * 6)]
    wide = spark.createDataFrame(rows, "home_id long, ts timestamp_ntz, Aggregate double, Appliance1 double")
    weather = spark.createDataFrame([(r[1] + dt.timedelta(minutes=20), float(r[1].hour), i) for i, r in enumerate(rows)],
                                    "ts timestamp_ntz, temperature double, seq long")
    apps = spark.createDataFrame([(1, "Dryer", 1.5, 6.0, 23.0, 2500.0), (1, "Washer", 2.0, 6.0, 22.0, 2000.0)],
                                 "home_id long, appliance string, runtime_hours double, earliest_start double, "
                                 "latest_finish double, power_rating double")
    plans = spark.createDataFrame([(1, "default", True, 2)],
                                  "home_id long, tariff_id string, allow_simultaneous boolean, max_simultaneous int")
    out = run_household_job(spark, wide, apps, tariff_table(spark), plans, tmp_dir, interval="1h",
                            boost_params={"rounds": 2}, weather=weather, weather_order="seq")
    assert "temperature" in out["processed"].columns
    table_ = spark.read.option("header", True).csv(f"{tmp_dir}/optimized_schedule")
    assert table_.columns == ["home_id", "Hour", "Price (£/kWh)", "Dryer", "Washer"] and table_.count() == 24


def test_household_job_fits_every_round(spark, monkeypatch):
    """the query's forecast has 200 rounds of 256 bins, as its SQL has."""
    from wattgrid.plans import catalog
    from wattgrid.plans.oracle import SQL

    rows = [(1 + k % 2, dt.datetime(2024, 1, 1) + dt.timedelta(hours=k // 2), f"m{k % 5}", 50.0 + k * 7919 % 101) for k in range(400)]
    wide = pivot_first(spark.createDataFrame([(h, t, c, w) for h, t, _, w in rows for c in EVENT_CHANNELS],
                                             "home_id long, ts timestamp_ntz, channel string, watts double").withColumn("seq", F.lit(0)), EVENT_CHANNELS)
    apps = spark.createDataFrame([(1, "Dryer", 1.5, 6.0, 23.0, 2500.0), (1, "Washer", 2.0, 6.0, 22.0, 2000.0)],
                                 "home_id long, appliance string, runtime_hours double, earliest_start double, latest_finish double, power_rating double")
    plans = spark.createDataFrame([(1, "default", True, 2)], "home_id long, tariff_id string, allow_simultaneous boolean, max_simultaneous int")
    made, job = [], catalog.run_household_job

    def run(*args, **kw):
        made.append(job(*args, **kw))
        return made[-1]
    fits, train = [], forecast.train_forecaster

    def trained(frame, features, **kw):
        fits.append((frame, features, train(frame, features, **kw)))
        return fits[-1][-1]
    monkeypatch.setattr(catalog, "run_household_job", run)
    monkeypatch.setattr(forecast, "train_forecaster", trained)
    monkeypatch.setattr(catalog, "table", lambda *_: None)
    monkeypatch.setattr(catalog, "readings_from_events", lambda _: None)
    monkeypatch.setattr(catalog, "pivot_first", lambda *_: wide)
    monkeypatch.setattr(catalog, "schedule_inputs", lambda *_: (apps, tariff_table(spark), plans))
    assert catalog.q_household_job(spark, "own rows").count() == 7
    (frame, features, model), = fits
    shown = [m.orderBy("tree", "node").collect() for m in (model.table, train(frame, features, params={"rounds": 200, "max_bins": 256}).table)]
    assert shown[0] == shown[1] and shown[0][-1]["tree"] == 200
    assert "range(1, 201)" in SQL["household_job"] and "* 256)" in SQL["household_job"]
