"""Column functions: time, sessions, and the mapping of raw fields."""
