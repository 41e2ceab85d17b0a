"""Sales analytics for an order system, written on Spark DataFrames.

CSV files are landed incrementally, staged, shaped into a star schema with
masked personal data, and summarised into marts, two labelled cubes, data
quality reports and small result tables.
"""
