"""Column helpers shared by the operators; everything here is a native expression."""
