"""Writers: layer tables, appends, exports and keyed upserts."""
