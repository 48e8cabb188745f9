"""Retail analytics on Spark DataFrames: customers, transactions and sales series."""

__version__ = "0.1.0"
