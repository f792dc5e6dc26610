"""Operators: each is a function from DataFrames to a DataFrame (or a fitted
model whose scoring is a set of column expressions)."""
