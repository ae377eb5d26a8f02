"""Operators of a training-data pipeline, their named queries and the SQL twins of those that SQL can express."""
