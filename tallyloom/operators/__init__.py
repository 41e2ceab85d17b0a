"""Reusable building blocks on DataFrames."""
