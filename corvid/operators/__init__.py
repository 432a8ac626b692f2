"""Operator families; each function takes and returns DataFrames."""
