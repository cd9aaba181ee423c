"""Reusable relational building blocks: filters, joins, windows, aggregates, time grids."""
