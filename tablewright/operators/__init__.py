"""Operators on DataFrames and on the tables that store them."""
