"""The registered questions: graphs shaped from the given tables, and the SQL to compare with."""
