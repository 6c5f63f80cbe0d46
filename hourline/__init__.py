"""hourline: hourly time series on Spark, for many series at once."""

__version__ = "0.1.0"
