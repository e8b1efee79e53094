"""Models and dashboard queries as functions from DataFrames to DataFrames."""
