from .asof import merge_nearest, merge_weather
from .features import (add_lag_features, add_rolling_features, add_target, feature_names,
                       prepare_features)
from .impute import backward_fill, drop_missing, forward_fill, handle_missing, interpolate_time
from .outliers import remove_outliers, zscore_stats
from .pivot import pivot_first
from .resample import bin_start, count_missing, fill_bins, resample_mean
from .scale import apply_minmax, fit_minmax, minmax_scale
from .sequences import make_sequences
from .split import chrono_split, split_ranges

__all__ = [
    "merge_nearest", "merge_weather", "add_lag_features", "add_rolling_features", "add_target",
    "feature_names", "prepare_features", "backward_fill", "drop_missing", "forward_fill",
    "handle_missing", "interpolate_time", "remove_outliers", "zscore_stats", "pivot_first",
    "bin_start", "count_missing", "fill_bins", "resample_mean", "apply_minmax", "fit_minmax",
    "minmax_scale", "make_sequences", "chrono_split", "split_ranges",
]
