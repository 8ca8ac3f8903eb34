"""Scans: raw grids, typed extracts, events, polygons and layer tables."""
