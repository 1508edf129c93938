"""Operators on change data: all take and return DataFrames."""
