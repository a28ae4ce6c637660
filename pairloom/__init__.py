"""Parallel-corpus processing on Spark: read, clean, filter, score, deduplicate, merge."""
