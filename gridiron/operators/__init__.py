"""Dataset builders: every function maps DataFrames to a lazy DataFrame."""
