"""Operators on DataFrames: dedup, semi and anti joins, realignment, profiles."""
