"""Catalogue operators: DataFrames in, DataFrame out, nothing collected but bounded control data."""
