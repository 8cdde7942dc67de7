"""Dataset operators: DataFrames in, DataFrames out."""
