"""Media catalogue and vector search on Spark: DataFrames in, DataFrames out."""
