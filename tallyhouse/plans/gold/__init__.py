"""Gold marts: pure functions from silver DataFrames to one DataFrame per mart.

Marts are unordered tables at the grain named in their docstring.
"""
