"""Table builders: pure functions from DataFrames and a date to a DataFrame."""
