"""Relational operators: functions from DataFrames to DataFrames."""
