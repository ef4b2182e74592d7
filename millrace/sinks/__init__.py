"""Writers, merges into stored tables, exports and checks."""
