"""Expressions to Columns: scalar, aggregate and window functions."""
