"""Column expressions; all of them are built from Spark's own functions."""
