"""Relational, tree and bonus operators: DataFrames in, DataFrames out."""
