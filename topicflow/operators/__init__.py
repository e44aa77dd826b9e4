"""Table-level operators on record-envelope DataFrames."""
