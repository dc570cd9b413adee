"""Operators on whole DataFrames: last-wins, keyed writes, rate shaping."""
