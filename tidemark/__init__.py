"""Market-data analytics on Spark: DataFrames in, DataFrames out."""
