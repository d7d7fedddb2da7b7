"""Reading flat tables, and storing graphs as Parquet."""
