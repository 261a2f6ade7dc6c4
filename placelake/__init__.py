"""Spark jobs for a small data lake: format, aggregate, model and stream place-keyed tables."""
