"""Operators over whole DataFrames: the member join, hot members, filters."""
