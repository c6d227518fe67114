"""Operators: functions from DataFrames to a DataFrame, planned by Catalyst."""
