"""Column functions: every one returns a Spark expression, none runs Python per row."""
