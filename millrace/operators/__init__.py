"""Operators: functions from DataFrames (and small specs) to DataFrames."""
