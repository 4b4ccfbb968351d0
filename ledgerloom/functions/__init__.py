"""Column functions: every one is a built-in Catalyst expression."""
