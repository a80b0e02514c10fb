"""Transaction scoring and analytics on Spark DataFrames, batch and streaming."""
