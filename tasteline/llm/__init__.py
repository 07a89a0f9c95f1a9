"""Operators for preparing training text, as Spark jobs."""
