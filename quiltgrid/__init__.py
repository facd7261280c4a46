"""Tabular analytics on Spark DataFrames, with the rules of spreadsheet functions."""
