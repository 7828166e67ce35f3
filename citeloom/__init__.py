"""Cited-record analytics on Spark: text, layout, status and serving operators over DataFrames."""

__version__ = "0.1.0"
