"""Operators for preparing training text: each takes DataFrames and returns DataFrames."""
