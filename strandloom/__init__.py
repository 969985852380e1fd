"""Sequence-evidence and training-data analytics on Spark DataFrames."""
