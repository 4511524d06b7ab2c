"""Operators take DataFrames and return DataFrames.

They are lazy, with two exceptions that say so: percentiles write their counted values once, and vector retrieval
fetches the query vectors it was given.
"""
