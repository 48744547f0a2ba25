"""Household load analytics on Spark: readings -> regular series -> features
-> forecast, and cost-minimal appliance schedules, for many homes at once."""

__version__ = "0.1.0"
