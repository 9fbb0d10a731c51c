"""The operators on the given tables, and the same results in SQL."""
