"""Column functions: native expressions, no Python on the executors."""
