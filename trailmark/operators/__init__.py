"""Operators on DataFrames: each takes and returns DataFrames and collects nothing, unless it says so."""
