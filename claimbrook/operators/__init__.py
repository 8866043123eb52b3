"""Claims-research operators: plain functions from DataFrames to DataFrames."""
