"""Frame-track analytics on Spark."""
