"""Coverage analytics on Spark."""
