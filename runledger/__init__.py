"""Verification, ranking and publishing of scored results with Spark DataFrames."""
