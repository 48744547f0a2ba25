"""The full household job - every home at once.

load -> preprocess (C1) -> features (C2) -> split (W9) -> cut lineage ->
train (M1) -> score and evaluate (M2, M3) -> importances (M4, T2) ->
schedules (O1) -> reports (R1-R6) -> sinks (S7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..constants import FORECAST_HORIZON, LAG_INTERVALS, RESAMPLE_INTERVAL, ROLLING_WINDOWS
from ..functions.channels import choose_target, feature_channels
from ..operators.asof import merge_weather
from ..operators.features import feature_names, prepare_features
from ..operators.scale import apply_minmax, fit_minmax
from ..operators.schedule import optimize_schedules
from ..operators.split import chrono_split
from ..session import materialize
from ..sources.sinks import write_csv, write_parquet
from ..util import value_columns
from . import forecast, reports
from .preprocess import preprocess


def fit_scaler_on_train(unscaled: DataFrame, columns: Sequence[str], featurize, *, keys=("home_id",),
                        ts: str = "ts") -> DataFrame:
    """D7 option: min-max params from the training rows only, applied to all.

    Scaling adds or removes no row, so the split found on the unscaled series
    is the split of the scaled one.  Params are one row per home and column
    (``fit_minmax``), joined back by home (no clipping outside the fit)."""
    train = featurize(unscaled).filter(F.col("split") == "train").select(*keys, ts)
    params = fit_minmax(unscaled.join(train, [*keys, ts], "left_semi"), columns, keys=keys, ts=ts)
    return apply_minmax(unscaled, params, columns, keys=keys)


def run_household_job(spark: SparkSession, wide: DataFrame, appliances: DataFrame, tariffs: DataFrame,
                      plans: DataFrame, output_dir: str | None = None, *,
                      channels: Sequence[str] | None = None, target: str | None = None,
                      features_from: Sequence[str] | None = None, interval: str = RESAMPLE_INTERVAL,
                      boost_params: dict | None = None, keys=("home_id",),
                      scaler_fit: str = "all", weather: DataFrame | None = None,
                      weather_order: str | None = None) -> dict[str, DataFrame]:
    """``weather`` ``(ts, <numeric columns>)`` is matched to the readings by
    nearest time (J1); its columns then count as channels.

    ``scaler_fit="all"`` fits min-max on every row before the split, as the
    reference does (D7); ``"train"`` fits it on the training rows only."""
    if weather is not None:
        wide = merge_weather(wide, weather, right_order=weather_order)
        if weather_order:
            wide = wide.drop(weather_order)
    chans = list(channels) if channels is not None else value_columns(wide, keys)
    target = target or choose_target(chans)
    feat_ch = list(features_from) if features_from is not None else feature_channels(chans)

    def featurize(series):
        return chrono_split(prepare_features(series, target, feat_ch, LAG_INTERVALS, ROLLING_WINDOWS,
                                             FORECAST_HORIZON, keys=keys), keys=keys)

    # A channel a home never reported is all NULL there; 0 for the model.
    if scaler_fit == "all":
        processed = preprocess(wide, chans, interval=interval, keys=keys).fillna(0.0, subset=chans)
    elif scaler_fit == "train":
        processed = fit_scaler_on_train(
            preprocess(wide, chans, interval=interval, keys=keys, normalize=False).fillna(0.0, subset=chans),
            chans, featurize, keys=keys)
    else:
        raise ValueError(f"scaler_fit must be 'all' or 'train', not {scaler_fit!r}")
    # Values to six places, as the forecast needs no more, and the last digits of
    # a mean depend on the order of its sum.  Many passes follow (fit, score).
    frame = featurize(materialize(processed))
    frame = materialize(frame.withColumns({f.name: F.round(F.round(f.name, 9), 6) for f in frame.schema.fields
                                           if isinstance(f.dataType, DoubleType)}))
    feats = feature_names(frame, keys=keys)
    model = forecast.train_forecaster(frame, feats, params=boost_params, keys=keys)
    predictions = materialize(forecast.predict(model, frame, keys=keys))
    metrics = forecast.evaluate(predictions)
    curves = forecast.round_metrics(model, frame)
    importances = forecast.feature_importances(model)

    result = optimize_schedules(appliances, tariffs, plans, keys=keys)
    optimal = result.homes.filter(F.col("status") == "optimal")
    totals = optimal.agg(F.sum("original_cost").alias("original_cost"),
                         F.sum("optimized_cost").alias("optimized_cost"))
    savings = totals.withColumns(reports.savings_metrics(F.col("original_cost"), F.col("optimized_cost")))
    out = {
        "processed": processed,
        "predictions": predictions,
        "metrics": metrics,
        "importances": importances,
        "round_metrics": curves,
        "model": model.table,
        "schedule": result.schedule.select(*keys, "appliance", "hour", "price", "is_on"),
        "homes": result.homes,
        "schedule_summary": reports.schedule_summary(result.schedule, keys),
        "hourly_power_cost": reports.hourly_power_cost(result.schedule, keys),
        "savings": reports.savings_and_peak(result.schedule, keys),
        "results_summary": reports.results_summary(metrics.filter(F.col("split") == "test"), savings),
    }
    if output_dir:
        base = output_dir.rstrip("/")
        # One column per appliance name (bounded by the appliances' vocabulary).
        names = [r[0] for r in result.schedule.select("appliance").distinct().orderBy("appliance").collect()]
        write_csv(reports.schedule_wide(result.schedule, names, keys=keys, labels=True), f"{base}/optimized_schedule")
        write_csv(out["schedule_summary"], f"{base}/schedule_summary")
        write_csv(out["results_summary"].orderBy("position").drop("position"), f"{base}/results_summary",
                  single_file=True)
        write_csv(metrics, f"{base}/metrics", single_file=True)
        write_csv(importances, f"{base}/feature_importance", single_file=True)
        write_csv(curves, f"{base}/round_metrics", single_file=True)
        write_parquet(model.table, f"{base}/model", partition_by=())
        write_parquet(predictions, f"{base}/predictions", partition_by=())
        write_parquet(out["homes"], f"{base}/homes")
    return out
