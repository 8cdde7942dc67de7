"""Pipelines over stored tables, and the queries over the given tables."""
