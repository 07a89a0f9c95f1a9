"""Implicit-feedback recommendation and evaluation as Spark DataFrame jobs."""
