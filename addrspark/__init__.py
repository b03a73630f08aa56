"""Address-data preparation on Spark DataFrames."""
