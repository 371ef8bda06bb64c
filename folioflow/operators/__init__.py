"""Operators; each takes and returns DataFrames (or columns) and collects nothing."""
