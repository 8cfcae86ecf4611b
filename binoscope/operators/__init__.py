"""DataFrame operators: every one takes and returns DataFrames with an explicit id column."""
