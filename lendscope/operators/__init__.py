"""Operators: functions from DataFrames to DataFrames, all lazy unless stated."""
