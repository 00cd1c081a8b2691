"""Training-data operators on Spark DataFrames. Nothing outside this package imports it."""
