"""Fleet-telemetry analytics as DataFrame-in, DataFrame-out PySpark operators."""

__version__ = "0.1.0"
