"""Lakehouse data operators written as PySpark DataFrame transformations.

Operators take DataFrames and return DataFrames; none of them creates a
session, and none pulls table data to the driver.
"""
