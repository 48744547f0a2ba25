from . import tables
from .readings import (channel_dimension, filter_variables, load_and_prepare, load_readings, read_combined_csv,
                       read_wide_csv, rename_channels, select_channels)
from .weather import load_weather
from .sinks import write_csv, write_parquet

__all__ = ["tables", "channel_dimension", "filter_variables", "load_and_prepare", "load_readings", "read_combined_csv",
           "read_wide_csv", "rename_channels", "select_channels", "load_weather",
           "write_csv", "write_parquet"]
