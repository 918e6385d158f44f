"""Operators over DataFrames: statistics, features, labels, models."""
