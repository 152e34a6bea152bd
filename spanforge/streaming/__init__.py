"""Structured Streaming variants of the row-local corpus plans."""
