"""Operators: functions from DataFrames to DataFrames. None of them touches a path."""
