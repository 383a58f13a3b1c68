"""Column-level functions; everything here is a built-in expression, never a Python UDF."""
