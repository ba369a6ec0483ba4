"""Operators: functions from DataFrames to DataFrames, and Spark ML stages."""
