"""Ordered, grouped and fitted operators over DataFrames."""
