"""Relational operators: joins, aggregates, windows, sets, search."""
