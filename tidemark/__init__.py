"""Market-stream analytics as Spark DataFrame jobs."""
