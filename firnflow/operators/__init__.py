"""Operators: each takes tables and returns a table."""
