"""Retail event analytics on Spark: plain functions from DataFrames to DataFrames."""
