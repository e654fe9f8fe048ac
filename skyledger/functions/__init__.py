"""Column functions: every one is a plain Catalyst expression."""
