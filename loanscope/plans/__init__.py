"""Pipeline outputs as functions from DataFrames to DataFrames."""
