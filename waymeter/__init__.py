"""Trip-duration analytics as Spark DataFrame, MLlib and Structured Streaming jobs."""
