"""Readers that give string-typed DataFrames of declared columns."""
