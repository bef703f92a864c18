"""Batch analyses: DataFrames in, DataFrames out, no action inside."""
