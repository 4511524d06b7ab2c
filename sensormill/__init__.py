"""Sensor-log lakehouse and data-quality operators as Spark DataFrame jobs."""

__version__ = "0.1.0"
