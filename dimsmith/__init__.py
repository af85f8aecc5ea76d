"""Dimensional warehouse building and analytical queries on Spark DataFrames."""

__version__ = "0.1.0"
