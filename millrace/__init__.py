"""User-level data jobs written as Spark DataFrame functions."""
