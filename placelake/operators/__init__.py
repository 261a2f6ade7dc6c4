"""Joins, aggregates, splits and the price model over DataFrames."""
