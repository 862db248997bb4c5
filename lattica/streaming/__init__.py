"""Rows as a stream: of a bounded result, or of an unbounded source."""
