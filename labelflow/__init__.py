"""Curation of two-axis labelled text with Spark DataFrames."""

__version__ = "0.1.0"
