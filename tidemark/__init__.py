"""Spark-native operators for hourly fact tables and transit-style event streams."""

__version__ = "0.1.0"
