"""Operators on DataFrames of rows and changes."""
