"""Column functions. Each one takes columns and returns a column."""
