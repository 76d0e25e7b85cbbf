"""Relational jobs: DataFrames in, DataFrame out."""
