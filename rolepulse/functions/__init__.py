"""Column functions: everything here is a plain expression, no Python runs per row."""
