"""Queries over the test tables, by family."""
