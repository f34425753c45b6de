"""Readers: event streams and tables, change rows, delimited lines, bounded relational tables."""
