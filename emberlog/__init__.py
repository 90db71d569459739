"""Log-anomaly analytics on Spark DataFrames and Structured Streaming."""
