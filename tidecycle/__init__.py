"""Spark-native analytics for periodic-activity time series."""
