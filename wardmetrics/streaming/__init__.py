"""Incremental loads: month plans, processed keys and file streams."""
