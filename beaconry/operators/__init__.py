"""Operators: functions from DataFrames to DataFrames. Columns they read are named in their docstrings."""
