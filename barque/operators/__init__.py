"""Operators from DataFrames of bars to DataFrames."""
