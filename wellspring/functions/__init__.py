"""Scalar helpers: every one takes and returns Spark Columns."""
