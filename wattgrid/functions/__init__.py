from .calendar import add_time_features, calendar_columns
from .metrics import regression_metrics, prediction_bounds, error_columns
from .formatting import clock_label, money

__all__ = ["add_time_features", "calendar_columns", "regression_metrics",
           "prediction_bounds", "error_columns", "clock_label", "money"]
