"""Operators on logs, ranges, splits and offsets; each takes and returns DataFrames."""
