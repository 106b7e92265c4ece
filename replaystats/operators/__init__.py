"""Relational operators on DataFrames. Columns, keys, thresholds and clock are arguments."""
