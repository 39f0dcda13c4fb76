"""Recommendation and text analytics on Spark DataFrames."""
