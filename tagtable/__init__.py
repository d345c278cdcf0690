"""Customer tag tables on Spark."""
