"""Retail sales analytics as plain Spark DataFrame, SQL and streaming code."""

__version__ = "0.1.0"
