"""Composed plans: bindings to the given tables, end-to-end jobs, the query registry."""
