"""Weighted price-change indices on Spark DataFrames."""

__version__ = "0.1.0"
