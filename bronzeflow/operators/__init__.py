"""Reusable DataFrame operators. All take and return DataFrames."""
