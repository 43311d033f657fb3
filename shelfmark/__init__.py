"""A corpus-catalog analytics library for Spark."""
