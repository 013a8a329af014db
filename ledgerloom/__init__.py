"""Registry analytics on Spark."""
