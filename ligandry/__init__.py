"""Spark-native analytics for molecular bioactivity data."""
