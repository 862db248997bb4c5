"""Relational and document queries as lazy Spark DataFrames."""
