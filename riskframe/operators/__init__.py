"""Operators: pure functions from DataFrames and settings to DataFrames."""
