"""Operators: functions from DataFrames to a DataFrame, built from column expressions."""
