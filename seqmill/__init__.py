"""Spark-native analytics for sequence-abundance data."""
