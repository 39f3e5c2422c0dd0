"""Operators for training-data corpora and their registered queries.

Every operator is a function from DataFrames to a DataFrame. Nothing outside this subpackage imports it.
"""
