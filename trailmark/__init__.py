"""Spark-native analytics for spatial trajectory data."""
