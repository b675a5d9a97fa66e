"""Governed, configuration-driven table loading and its analytics on Spark DataFrames."""

__version__ = "0.1.0"
