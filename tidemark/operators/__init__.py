"""Operators on market data: DataFrames in, DataFrames out, lazy."""
