"""Column functions: plain Spark expressions, usable inside any select."""
