"""Spark-native analytics for tables of research-paper records."""

__version__ = "0.1.0"
