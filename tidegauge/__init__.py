"""Trend analytics on event streams and tables, written for Spark."""

__version__ = "0.1.0"
