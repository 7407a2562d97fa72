"""Silver builders: typed, deduplicated tables from raw frames.

Raw frames carry the source system's column names plus ``_loaded_at``; every builder is a pure
function that casts without failing, keeps rows with complete keys and takes the newest load.
"""
