"""Fixed values and defaults.

The values under "Fixed values" must equal the reference's so that results
match it (tariffs, appliance set, channel naming, feature names, report
labels).  Everything else in the library is derived from parameters.
"""

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results)
# ---------------------------------------------------------------------------

# Hourly prices in GBP/kWh, position = hour of day 0..23.
DEFAULT_TARIFF = [
    0.08, 0.08, 0.08, 0.08, 0.08, 0.08, 0.08,
    0.12, 0.14, 0.16, 0.16, 0.16,
    0.18, 0.18, 0.18, 0.20,
    0.35, 0.40, 0.40, 0.35,
    0.22, 0.18, 0.14,
    0.10,
]
FLAT_TARIFF = [0.15] * 24
STEEP_TARIFF = [
    0.05, 0.05, 0.05, 0.05, 0.05, 0.05,
    0.10, 0.10, 0.10, 0.10, 0.10, 0.10,
    0.20, 0.20, 0.20,
    0.50, 0.50, 0.50, 0.50,
    0.20, 0.20, 0.20, 0.20,
    0.10,
]
TARIFFS = {"default": DEFAULT_TARIFF, "flat": FLAT_TARIFF, "steep": STEEP_TARIFF}

# Flexible appliances: (appliance, channel, runtime_hours, earliest_start,
# latest_finish, power_rating in W).
DEFAULT_APPLIANCES = [
    ("Dishwasher", "Appliance5", 2.0, 0, 24, 1200.0),
    ("Washing Machine", "Appliance4", 2.0, 6, 22, 2000.0),
    ("Tumble Dryer", "Appliance3", 1.5, 6, 23, 2500.0),
]
POOL_PUMP = ("Pool Pump", "Pool", 6.0, 0, 24, 1500.0)
ELECTRIC_VEHICLE = ("Electric Vehicle", "EV", 4.0, 22, 7, 7000.0)

# Long-format variable ids of the combined readings file and their channels.
VARIABLE_PREFIX = "TimeSeriesVariable"
VARIABLE_CHANNELS = {
    "TimeSeriesVariable1": "Aggregate",
    "TimeSeriesVariable2": "Appliance1",
    "TimeSeriesVariable3": "Appliance2",
    "TimeSeriesVariable4": "Appliance3",
    "TimeSeriesVariable5": "Appliance4",
    "TimeSeriesVariable6": "Appliance5",
    "TimeSeriesVariable7": "Appliance6",
    "TimeSeriesVariable8": "Appliance7",
    "TimeSeriesVariable9": "Appliance8",
    "TimeSeriesVariable10": "Appliance9",
}
# Ids kept by the reference's filter pattern (end of the id, unanchored start).
VARIABLE_ID_PATTERN = r"TimeSeriesVariable[1-9]$|TimeSeriesVariable10$"
# Column names of the combined long CSV.
LONG_ID_COL = "TimeSeriesVariable/@id"
LONG_TIME_COL = "dateTime"
LONG_VALUE_COL = "data"
# Wide per-home file name.
WIDE_FILE_TEMPLATE = "CLEAN_House{home_id}.csv"
COMBINED_DIR = "REFIT_TIME_SERIES_VALUES"
COMBINED_FILE = "REFIT_TIME_SERIES_VALUES.csv"

# Weather time-column candidates, in order.
WEATHER_TIME_CANDIDATES = ["timestamp", "datetime", "date"]

# Calendar features, in the order they are added.
TIME_FEATURES = [
    "hour", "day_of_week", "day_of_month", "month", "is_weekend",
    "hour_sin", "hour_cos", "day_sin", "day_cos",
]
# Name tokens that mark a column as derived (not a raw channel).
DERIVED_TOKENS = ["lag", "rolling", "hour", "day", "sin", "cos", "weekend"]
CHANNEL_TOKENS = ["Appliance", "Aggregate"]

# Schedule summary labels and results summary metric labels.
SUMMARY_LABELS = {
    "appliance": "Appliance",
    "power_w": "Power (W)",
    "runtime_h": "Runtime (h)",
    "original_start": "Original Start",
    "original_end": "Original End",
    "optimized_start": "Optimized Start",
    "optimized_end": "Optimized End",
    "original_cost": "Original Cost (£)",
    "optimized_cost": "Optimized Cost (£)",
    "savings": "Savings (£)",
}
SCHEDULE_WIDE_LABELS = {"hour": "Hour", "price": "Price (£/kWh)"}
RESULT_METRICS = [
    ("Prediction RMSE", "rmse", "%.4f"),
    ("Prediction MAE", "mae", "%.4f"),
    ("Prediction MAPE (%)", "mape", "%.2f"),
    ("Original Cost (£)", "original_cost", "%.4f"),
    ("Optimized Cost (£)", "optimized_cost", "%.4f"),
    ("Absolute Savings (£)", "absolute_savings", "%.4f"),
    ("Percent Savings (%)", "percent_savings", "%.2f"),
]

# ---------------------------------------------------------------------------
# Defaults (the reference's configuration)
# ---------------------------------------------------------------------------
RESAMPLE_INTERVAL = "15min"
MISSING_VALUE_METHOD = "ffill"
OUTLIER_THRESHOLD = 3.0
LAG_INTERVALS = [1, 2, 3, 4]
ROLLING_WINDOWS = [4, 8, 12]
FORECAST_HORIZON = 4
FEATURE_CHANNELS = 5
TOP_N_IMPORTANCES = 20
BOOST_PARAMS = {
    "rounds": 200,
    "max_depth": 6,
    "learning_rate": 0.1,
    "subsample": 0.8,
    "colsample": 0.8,
    "seed": 42,
}
