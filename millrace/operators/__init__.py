"""Building blocks that take and return DataFrames and name their columns."""
