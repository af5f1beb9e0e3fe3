"""Operators over DataFrames: aggregation, joins, row windows, data checks."""
