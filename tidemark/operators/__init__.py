"""Batch operators: DataFrames in, DataFrames out."""
