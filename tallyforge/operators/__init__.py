"""Cleaning and comparison operators over DataFrames."""
