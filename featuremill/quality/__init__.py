"""Data-quality checks over DataFrames."""
