"""Spark-native analytics for market, macro-economic and commerce data."""

__version__ = "0.1.0"
