"""Operators: each takes DataFrames plus column lists and returns a DataFrame of DataFrame/SQL expressions."""
