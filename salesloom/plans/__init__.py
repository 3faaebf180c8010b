"""Bronze, silver and gold tables as functions from DataFrames to a DataFrame."""
